"""Incremental loads and history: watermark increments, SCD type 2,
de-duplication on row hash, soft delete, reference inactivation, change
events.

Stock Spark has no MERGE for parquet tables, so every "upsert" is a join
producing the next version, written to a new location by the caller (never
overwriting the path being read). Written partitioned by ``is_current``, SCD2
history gives a load its current rows by partition pruning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import JSON_OPTIONS, md5_record_hash
from .skew import DEFAULT_MAX_KEY_ROWS, salted_join


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp_ntz")


def watermark_increment(existing: DataFrame, incoming: DataFrame, col: str) -> DataFrame:
    """Rows of ``incoming`` newer than max(col) already loaded. The watermark
    is one scalar (a single-row aggregate), so the resulting filter is a
    literal that pushes down into the scan."""
    # carried as text and cast back to the column's own type, so no
    # Python-side time zone conversion can shift it; the cast of a literal
    # is constant-folded, keeping the filter pushable into the scan
    wm = existing.agg(F.max(col).cast("string").alias("wm")).first()["wm"]
    if wm is None:
        return incoming
    return incoming.filter(F.col(col) > F.lit(wm).cast(incoming.schema[col].dataType))


def with_hash(df: DataFrame, keys, name: str = "record_hash") -> DataFrame:
    attrs = [c for c in df.columns if c not in keys]
    return df.withColumn(name, md5_record_hash(attrs))


def faulty_keys(df: DataFrame, keys) -> DataFrame:
    """(keys..., _same) of the keys that don't name one row: held by several rows (``_same``: all equal) or with a NULL column (``_same`` is
    NULL). One hash aggregate over key and two 64-bit content hashes, combined before the shuffle; usually the result is small, so callers
    that need it twice store it (``plans.runs.set_aside``)."""
    keys = list(keys)
    content = [F.col(c) for c in df.columns]
    one, two = F.xxhash64(*content), F.xxhash64(F.lit(1), *content)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(one).alias("_a"), F.max(one).alias("_b"), F.min(two).alias("_c"), F.max(two).alias("_d"))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    same = (F.col("_a") == F.col("_b")) & (F.col("_c") == F.col("_d"))
    return g.filter((F.col("_n") > 1) | ~whole).select(*keys, F.when(whole, same).alias("_same"))


def usable(df: DataFrame, keys, faulty: DataFrame | None = None) -> DataFrame:
    """Rows with a key that names one state: no NULL key column, and no other,
    different row of the same key (equal rows count once). ``faulty``: the stored ``faulty_keys``."""
    keys = list(keys)
    faulty = faulty_keys(df, keys) if faulty is None else faulty
    rows = df.dropna(subset=keys)
    single = rows.join(faulty.select(*keys), keys, "left_anti")
    repeated = rows.join(faulty.filter("_same").select(*keys), keys, "left_semi")
    return single.select(*df.columns).unionByName(repeated.select(*df.columns).distinct())


def unusable(df: DataFrame, keys, faulty: DataFrame | None = None) -> DataFrame:
    """The other rows, for quarantine, with ``key_fault``: 'null_key' or 'ambiguous_key'."""
    keys = list(keys)
    faulty = faulty_keys(df, keys) if faulty is None else faulty
    null_key = ~reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    several = df.join(faulty.filter("not _same").select(*keys), keys, "left_semi").distinct()
    return (df.filter(null_key).distinct().withColumn("key_fault", F.lit("null_key"))
            .unionByName(several.select(*df.columns).withColumn("key_fault", F.lit("ambiguous_key"))))


def _differs(left: str, right: str, cols) -> Column:
    """Whether any column differs; NULL equals NULL only."""
    return reduce(lambda a, b: a | b, [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols], F.lit(False))


def scd2_initial(snapshot: DataFrame, keys, load_ts, batch_id: str) -> DataFrame:
    return with_hash(snapshot, keys).select(
        "*", _ts(load_ts).alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"), F.lit(batch_id).alias("batch_id"))


def scd2_apply(history: DataFrame, incoming: DataFrame, keys, load_ts, batch_id: str, faulty: DataFrame | None = None) -> DataFrame:
    """Type-2 history: unchanged keys keep their row; a change in any column closes
    the current row (valid_to, is_current=false) and adds a new current
    version; new keys are inserted; keys missing from ``incoming`` stay as
    they are (deletes are the soft-delete operator's job).

    Incoming rows with a NULL key or with different rows for one key
    (``unusable``) change nothing; callers quarantine them (``faulty``: their stored keys). Only current rows take part in the full outer
    join on the key; closed versions pass through untouched. Each joined row emits its 0..2 output
    rows through one array+inline, so the join runs once.

    Loads come in the order of their times: a row of ``history`` that begins after ``load_ts`` fails the job. For loads in any
    order see ``runs_insert``."""
    keys = list(keys)
    attrs = [c for c in incoming.columns if c not in keys]
    inc = with_hash(usable(incoming, keys, faulty), keys)
    late = F.raise_error(F.concat(F.lit("load out of order: history holds a row from "), F.col("valid_from").cast("string"), F.lit(", later than the load")))
    history = history.withColumn("valid_from", F.when(F.col("valid_from") > _ts(load_ts), late.cast("timestamp_ntz")).otherwise(F.col("valid_from")))
    cur = history.filter(F.col("is_current"))
    closed = history.filter(~F.col("is_current"))
    # presence is a flag of its own: a NULL key in old history matches nothing and stays
    h, i = cur.withColumn("_here", F.lit(True)).alias("h"), inc.withColumn("_here", F.lit(True)).alias("i")
    j = h.join(i, [F.col(f"h.{k}") == F.col(f"i.{k}") for k in keys], "full_outer")
    has_h, has_i = F.col("h._here").isNotNull(), F.col("i._here").isNotNull()
    changed = has_h & has_i & _differs("h", "i", attrs)
    out_cols = keys + attrs + ["record_hash"]
    t = _ts(load_ts)

    def version(side, valid_from, valid_to, current, batch):
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in out_cols],
                        valid_from.alias("valid_from"), valid_to.alias("valid_to"),
                        F.lit(current).alias("is_current"), batch.alias("batch_id"))

    keep_old = version("h", F.col("h.valid_from"), F.col("h.valid_to"), True, F.col("h.batch_id"))
    close_old = version("h", F.col("h.valid_from"), t, False, F.col("h.batch_id"))
    new_ver = version("i", t, F.lit(None).cast("timestamp_ntz"), True, F.lit(batch_id))
    first = F.when(changed, close_old).when(has_h, keep_old)
    second = F.when(changed | ~has_h, new_ver)
    rows = j.select(F.inline(F.filter(F.array(first, second), lambda x: x.isNotNull())))
    return closed.unionByName(rows.select(*closed.columns))


# ---------------------------------------------------------------- loads in any order
RUN_COLUMNS = ("seen_from", "seen_to", "batch_id")


def runs_initial(snapshot: DataFrame, keys, load_ts, batch_id: str, faulty: DataFrame | None = None) -> DataFrame:
    """A history as *runs* of loads, for loads in any order: one row per key and stretch of consecutive loads that all held the key with this
    content, from the load time ``seen_from`` to ``seen_to``. ``seen_to`` is NULL while the newest load holds it, so a load changes only
    the runs of keys that changed, came or went."""
    return with_hash(usable(snapshot, keys, faulty), keys).select(
        "*", _ts(load_ts).alias("seen_from"), F.lit(None).cast("timestamp_ntz").alias("seen_to"), F.lit(batch_id).alias("batch_id"))


def runs_insert(history: DataFrame, incoming: DataFrame, keys, load_ts, batch_id: str, loads, faulty: DataFrame | None = None) -> DataFrame:
    """The runs after one more load, whose time may lie anywhere among ``loads``, the (time, batch id) of all loads before (metadata: one per
    load; times as text that sorts in order). The result is what the loads would give in any other order.

    Of each key only runs beside the new load matter, two at most: one that spans its time, or one that ends with the load before it and one that
    begins with the load after it. They are brought to one row per key by a grouped maximum and joined with the load's rows; a run that spans the time of a
    load that lacks the key or holds another content is split, equal neighbours are extended or become one. All other runs pass through
    without a shuffle. A load time that is known already raises ``ValueError``. Rows of ``incoming`` without a usable key change nothing:
    the key counts as not seen by the load."""
    keys, load_ts = list(keys), str(load_ts)
    loads = sorted((str(t), b) for t, b in loads)
    if load_ts in [t for t, _ in loads]:
        raise ValueError(f"load {load_ts} is in the history already")
    before = max((x for x in loads if x[0] < load_ts), default=None)
    after = min((x for x in loads if x[0] > load_ts), default=None)
    t, t_before, t_after = (_ts(x) for x in (load_ts, before and before[0], after and after[0]))
    content = [c for c in history.columns if c not in (*keys, *RUN_COLUMNS)]
    inc = with_hash(usable(incoming, keys, faulty), keys)
    begins, ends = F.col("seen_from"), F.col("seen_to")
    spans = (begins < t) & (ends.isNull() | (ends > t)) if after else F.lit(False)
    left = (ends.isNull() if after is None else ends == t_before) if before else F.lit(False)
    right = begins == t_after if after else F.lit(False)
    beside = F.coalesce(spans | left | right, F.lit(False))
    packed = F.struct(*[F.col(c) for c in (*content, *RUN_COLUMNS)])
    near = history.filter(beside).groupBy(*keys).agg(*[F.max(F.when(F.coalesce(test, F.lit(False)), packed)).alias(name)
                                                      for name, test in (("_in", spans), ("_left", left), ("_right", right))])
    h, i = near.withColumn("_known", F.lit(True)).alias("h"), inc.withColumn("_here", F.lit(True)).alias("i")
    j = h.join(i, [F.col(f"h.{k}") == F.col(f"i.{k}") for k in keys], "full_outer")
    here = F.col("i._here").isNotNull()
    new = F.struct(*[F.col(f"i.{c}").alias(c) for c in content])
    none = F.lit(None).cast("timestamp_ntz")

    def equal(run):
        return here & run.isNotNull() & reduce(lambda a, b: a & b, [run[c].eqNullSafe(F.col(f"i.{c}")) for c in content])

    def row(of, begin, end, batch):
        return F.struct(*[F.coalesce(F.col(f"h.{k}"), F.col(f"i.{k}")).alias(k) for k in keys], *[of[c].alias(c) for c in content],
                        begin.alias("seen_from"), end.alias("seen_to"), batch.alias("batch_id"))

    inside, l, r = F.col("h._in"), F.col("h._left"), F.col("h._right")  # noqa: E741
    splits = inside.isNotNull() & ~F.coalesce(equal(inside), F.lit(False))
    on_left, on_right = F.coalesce(equal(l), F.lit(False)), F.coalesce(equal(r), F.lit(False))
    mine = F.lit(batch_id)
    own_end = none if after is None else t
    out = [
        F.when(inside.isNotNull() & ~splits, row(inside, inside["seen_from"], inside["seen_to"], inside["batch_id"])),
        F.when(splits, row(inside, inside["seen_from"], t_before, inside["batch_id"])),
        F.when(splits, row(inside, t_after, inside["seen_to"], F.lit(after[1] if after else None))),
        # the run before ends with the load before, unless it goes on in this one
        F.when(l.isNotNull(), row(l, l["seen_from"], F.when(on_left & on_right, r["seen_to"]).when(on_left, own_end).otherwise(t_before), l["batch_id"])),
        F.when(r.isNotNull() & ~(on_left & on_right), row(r, F.when(on_right, t).otherwise(r["seen_from"]), r["seen_to"],
                                                          F.when(on_right, mine).otherwise(r["batch_id"]))),
        F.when(here & (inside.isNull() | splits) & ~on_left & ~on_right, row(new, t, own_end, mine)),
    ]
    rows = j.select(F.inline(F.filter(F.array(*out), lambda x: x.isNotNull())))
    return history.filter(~beside).unionByName(rows.select(*history.columns))


def runs_versions(history: DataFrame, keys) -> DataFrame:
    """Type-2 rows of a history of runs, as ``scd2_apply`` gives them for loads in order: a key that a load lacks stays as it is, so runs of one
    content with only a gap between them are one version; it ends where the next content begins. A window per key: a key has one row per run."""
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy("seen_from")
    begins = ~F.coalesce(F.lag("record_hash").over(order) == F.col("record_hash"), F.lit(False))
    first = history.withColumn("_begins", begins).filter("_begins").drop("_begins", "seen_to").withColumnRenamed("seen_from", "valid_from")
    ends = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from"))
    out = first.withColumn("valid_to", ends).withColumn("is_current", F.col("valid_to").isNull())
    return out.select(*[c for c in history.columns if c not in RUN_COLUMNS], "valid_from", "valid_to", "is_current", "batch_id")


def dedup_earliest(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep the earliest row per ``keys`` by ``order_cols``. Implemented as
    min(struct(order..., rest...)) per group, which aggregates partially on
    the map side — a group holding a third of all rows never lands in one
    task, unlike a row_number window."""
    keys, order_cols = list(keys), list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest]).alias("_row")
    g = df.groupBy(*keys).agg(F.min(packed).alias("_row"))
    return g.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in order_cols + rest]).select(*df.columns)


def soft_delete(bronze: DataFrame, snapshot: DataFrame, keys, deleted_at,
                flag: str = "_bronze_is_deleted", stamp: str = "_bronze_deleted_at",
                max_key_rows: int = DEFAULT_MAX_KEY_ROWS) -> DataFrame:
    """Bronze rows whose key is absent from the new full snapshot are
    flagged deleted. Bronze may hold many rows per key (history, repeated loads): its keys are counted before the shuffle and
    those missing in the snapshot, usually few, are joined back to the rows. A gone key with more than ``max_key_rows`` rows is
    spread over several tasks (``operators.skew``); the count that tells is the one of the keys."""
    keys = list(keys)
    data = [c for c in bronze.columns if c not in (flag, stamp)]
    # a row that was deleted before keeps its first deletion time
    known = {flag, stamp} <= set(bronze.columns)
    since = F.when(F.col(flag), F.col(stamp)) if known else F.lit(None).cast("timestamp_ntz")
    rows = bronze.select(*data, since.alias("_since"))
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    whole = rows.filter(has_key)
    counted = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).join(snapshot.select(*keys), keys, "left_anti")
    gone = counted.select(*keys, F.lit(True).alias("_gone_now"))
    j = salted_join(whole, gone, keys, "left", max_key_rows, counts=counted).select(*rows.columns, F.coalesce("_gone_now", F.lit(False)).alias("_gone_now"))
    # a NULL key is in no snapshot: those rows need no join, and never meet in one task
    j = j.unionByName(rows.filter(~has_key).withColumn("_gone_now", F.lit(True)))
    gone = F.col("_gone_now")
    return j.select(*data, gone.alias(flag), F.when(gone, F.coalesce(F.col("_since"), _ts(deleted_at))).alias(stamp))


def inactivate(reference: DataFrame, snapshot: DataFrame, keys, as_of: str, by: str,
               max_key_rows: int = DEFAULT_MAX_KEY_ROWS) -> DataFrame:
    """Reference rows missing from the new snapshot become inactive with the
    inactivation date and actor filled from parameters."""
    marks = ("is_active", "inactivated_date", "inactivated_by")
    known = set(marks) <= set(reference.columns)
    before = F.struct(*[F.col(c) for c in marks]) if known else F.lit(None).cast("struct<is_active:boolean,inactivated_date:date,inactivated_by:string>")
    data = [c for c in reference.columns if c not in marks]
    marked = soft_delete(reference.select(*data, before.alias("_before")), snapshot, keys, as_of, flag="_gone", stamp="_gone_at",
                         max_key_rows=max_key_rows)
    gone, old = F.col("_gone"), F.col("_before")
    still = F.coalesce(~old["is_active"], F.lit(False))   # inactive already: date and actor stay
    return marked.select(*data, (~gone).alias("is_active"),
                         F.when(gone, F.when(still, old["inactivated_date"]).otherwise(F.lit(as_of).cast("date"))).alias("inactivated_date"),
                         F.when(gone, F.when(still, old["inactivated_by"]).otherwise(F.lit(by))).alias("inactivated_by"))


def change_events(old: DataFrame, new: DataFrame, keys, table: str, event_ts, old_faulty: DataFrame | None = None,
                  new_faulty: DataFrame | None = None) -> DataFrame:
    """Snapshot diff -> change events (table, operation I/U/D, key, data
    JSON of the new row, or of the old row for deletes, event time). A key
    with different rows on either side gives no event: its state is unknown
    there, not missing. Callers quarantine those rows (``unusable``; ``old_faulty`` and ``new_faulty``: their stored keys)."""
    keys = list(keys)
    cols = [c for c in new.columns]
    attrs = [c for c in cols if c not in keys]
    old_faulty = faulty_keys(old, keys) if old_faulty is None else old_faulty
    new_faulty = faulty_keys(new, keys) if new_faulty is None else new_faulty
    unknown = lambda faulty: faulty.filter("not _same").select(*keys)
    o = usable(old, keys, old_faulty).join(unknown(new_faulty), keys, "left_anti").withColumn("_here", F.lit(True)).alias("o")
    n = usable(new, keys, new_faulty).join(unknown(old_faulty), keys, "left_anti").withColumn("_here", F.lit(True)).alias("n")
    j = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    has_o, has_n = F.col("o._here").isNotNull(), F.col("n._here").isNotNull()
    op = F.when(has_o & has_n & _differs("o", "n", attrs), "U").when(~has_o, "I").when(~has_n, "D")
    data = F.when(has_n, F.to_json(F.struct(*[F.col(f"n.{c}").alias(c) for c in cols]), JSON_OPTIONS)) \
        .otherwise(F.to_json(F.struct(*[F.col(f"o.{c}").alias(c) for c in cols]), JSON_OPTIONS))
    parts = [F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys]
    key = parts[0] if len(keys) == 1 else F.to_json(F.struct(*parts), JSON_OPTIONS)   # a composite key as one JSON text
    return j.select(F.lit(table).alias("table_name"), op.alias("operation"), key.alias("record_key"),
                    data.alias("data"), _ts(event_ts).alias("event_ts")).filter(F.col("operation").isNotNull())

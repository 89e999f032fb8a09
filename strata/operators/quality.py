"""Data-quality checks. Every check returns rows of
(check_name, table_name, column_name, failures, ok) plus check-specific
detail columns, so results of many checks union into one report.

Each check is a single aggregate pass (count_if lists instead of one job
per column); key checks pre-aggregate before any shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _row(check: str, table: str, column: str | None, failures: Column, **extra) -> list[Column]:
    return [F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
            F.lit(column).cast("string").alias("column_name"),
            failures.cast("bigint").alias("failures"),
            (failures.cast("bigint") == 0).alias("ok")] + [v.alias(k) for k, v in extra.items()]


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def counts(named: dict) -> DataFrame:
    """(name, n) for several DataFrames — one union of COUNT(*) aggregates."""
    return union_all([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("name"), "n")
                      for k, df in named.items()])


def reconcile(named: dict, rules) -> DataFrame:
    """``rules``: (check_name, table_name, left_names, right_names): the sum
    of counts on the left must equal the sum on the right."""
    c = counts(named)
    wide = c.agg(*[F.sum(F.when(F.col("name") == k, F.col("n"))).alias(k) for k in named])
    parts = []
    for check, table, left, right in rules:
        lhs = sum((F.coalesce(F.col(k), F.lit(0)) for k in left), F.lit(0))
        rhs = sum((F.coalesce(F.col(k), F.lit(0)) for k in right), F.lit(0))
        parts.append(wide.select(*_row(check, table, None, F.abs(lhs - rhs),
                                       expected=lhs.cast("bigint"), actual=rhs.cast("bigint"))))
    return union_all(parts)


def duplicates(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once, with their counts (partial aggregation
    map-side, so a hot key is combined before the shuffle)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def sum_match(orders: DataFrame, lineitem: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Per order status: stated order totals vs totals recomputed from line
    items, in exact decimals. Line items are summed per order first, so the
    join moves one row per order, not one per line."""
    money = lambda c: F.col(c).cast("decimal(18,2)")
    rev = money("l_extendedprice") * (F.lit(1) - money("l_discount")) * (F.lit(1) + money("l_tax"))
    per_order = lineitem.groupBy("l_orderkey").agg(F.sum(rev).alias("line_total"))
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", money("o_totalprice").alias("tp"))
    j = o.join(per_order, "l_orderkey", "left")
    agg = j.groupBy("o_orderstatus").agg(F.sum("tp").cast("decimal(18,2)").alias("expected"),
                                         F.coalesce(F.sum("line_total"), F.lit(0)).cast("decimal(18,2)")
                                         .alias("actual"))
    diff = F.abs(F.col("expected") - F.col("actual")).cast("decimal(18,2)")
    return agg.select(
        F.lit("sum_match").alias("check_name"), F.lit("orders").alias("table_name"),
        F.col("o_orderstatus").alias("column_name"), "expected", "actual", diff.alias("difference"),
        (diff <= F.lit(tolerance).cast("decimal(18,2)")).alias("ok"))


PAIR_COLS = ["child_table", "child_column", "parent_table", "parent_column"]


def _key(df: DataFrame, columns, as_text=()) -> list[Column]:
    """Key columns ``_k0``, ``_k1``, ... of a relationship."""
    return [(F.col(c).cast("string") if i in as_text else F.col(c)).alias(f"_k{i}") for i, c in enumerate(columns)]


def _mixed(child: DataFrame, child_cols, parent: DataFrame, parent_cols) -> list[int]:
    """Places where text meets another type; those keys are compared as text."""
    text = lambda df, c: df.schema[c].dataType.typeName() in ("string", "char", "varchar")
    return [i for i, (c, p) in enumerate(zip(child_cols, parent_cols)) if text(child, c) != text(parent, p)]


def orphan_rows(child: DataFrame, child_cols, parent: DataFrame, parent_cols) -> DataFrame:
    """One row (orphan_rows): child rows whose non-null key, of any type, has
    no parent.

    Child keys are counted first (partial aggregation map-side: a key that
    holds a third of all rows is one row per map task before the shuffle),
    parent keys are made distinct, and both sides meet on the key they were
    shuffled on once. The join is an outer one, so Catalyst keeps the
    aggregation below it (a left-anti join would be pushed beneath the
    aggregate); AQE broadcasts the parent keys when they measure small."""
    child_cols, parent_cols = list(child_cols), list(parent_cols)
    text = _mixed(child, child_cols, parent, parent_cols)
    names = [f"_k{i}" for i in range(len(child_cols))]
    keys = child.select(*_key(child, child_cols, text)).dropna().groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    pk = parent.select(*_key(parent, parent_cols, text)).dropna().distinct().withColumn("_hit", F.lit(True))
    j = keys.join(pk, names, "left")
    return j.agg(F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("orphan_rows"))


def is_unique(df: DataFrame, columns) -> DataFrame:
    """One row (parent_unique): no non-null key occurs twice."""
    keys = df.select(*_key(df, columns)).dropna()
    n = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("_n"))
    return n.agg((F.coalesce(F.max("_n"), F.lit(1)) <= 1).alias("parent_unique"))


def orphan_report(frames: dict, pairs) -> DataFrame:
    """(child_table, child_column, parent_table, parent_column, orphan_rows)
    of pairs of single key columns, each by ``orphan_rows``; the stages of
    the pairs are independent, so Spark runs them side by side."""
    return union_all([orphan_rows(frames[ct], [cc], frames[pt], [pc]).select(
        *[F.lit(v).alias(k) for k, v in zip(PAIR_COLS, (ct, cc, pt, pc))], "orphan_rows") for ct, cc, pt, pc in sorted(set(pairs))])


def foreign_keys(tables: dict, fks) -> DataFrame:
    """Orphan child rows per relationship; rows with a NULL in the child key
    are ignored."""
    return union_all([orphan_rows(tables[fk.child], fk.child_cols, tables[fk.parent], fk.parent_cols).select(
        *_row("foreign_key", fk.child, ",".join(fk.child_cols), F.col("orphan_rows"), parent_table=F.lit(fk.parent),
              parent_column=F.lit(",".join(fk.parent_cols)))) for fk in fks])


def nulls_in(df: DataFrame, table: str, columns, check: str) -> DataFrame:
    """count_if(c IS NULL) for each column in one pass, one row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    # all rows come from the one aggregate: a union of its projections would be pruned apart and scan once per column
    return agg.select(F.inline(F.array(*[F.struct(*_row(check, table, c, F.col(f"_n{i}"))) for i, c in enumerate(columns)])))


def completeness(df: DataFrame, table: str, required) -> DataFrame:
    """Required columns must exist and hold no NULL. A missing column fails
    with every row counted."""
    present = [c for c in required if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(F.col(c).isNull()).alias(f"_n{i}")
                                                for i, c in enumerate(present)]
    agg = df.agg(*aggs)
    parts = []
    for c in required:
        if c in present:
            failures, exists = F.col(f"_n{present.index(c)}"), F.lit(True)
        else:
            failures, exists = F.col("_rows"), F.lit(False)
        parts.append(F.struct(*_row("completeness", table, c, failures, column_present=exists)))
    return agg.select(F.inline(F.array(*parts)))


def uniqueness(df: DataFrame, table: str, keys) -> DataFrame:
    """Rows minus distinct keys (via a grouped count, partial aggregation first)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    agg = g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("distinct_keys"))
    return agg.select(*_row("uniqueness", table, ",".join(keys), F.col("total_rows") - F.col("distinct_keys"),
                            total_rows=F.col("total_rows").cast("bigint"),
                            distinct_keys=F.col("distinct_keys").cast("bigint")))


def freshness(df: DataFrame, table: str, ts_col: str, as_of: str, max_lag_seconds: int) -> DataFrame:
    """Newest timestamp vs ``as_of``; fails when older than the allowed lag."""
    agg = df.agg(F.max(ts_col).alias("latest"))
    lag = (F.timestamp_diff("MICROSECOND", F.col("latest"), F.lit(as_of).cast("timestamp_ntz"))
           / F.lit(1000000)).cast("bigint")
    return agg.select(*_row("freshness", table, ts_col, F.when(lag > max_lag_seconds, 1).otherwise(0),
                            latest=F.col("latest"), lag_seconds=lag))

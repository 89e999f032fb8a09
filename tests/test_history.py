"""History operators: SCD2 idempotence and currency, dedup vs brute force."""

from pyspark.sql import functions as F

from strata import contracts as C
from strata.operators import history as H
from strata.plans import fixtures as FX
from strata.plans.registry import QUERIES

from .conftest import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_scd2_one_current_row_per_key(spark):
    out = QUERIES["scd2_apply"](spark, SF001)
    bad = out.filter("is_current").groupBy("c_custkey").count().filter("count > 1").count()
    assert bad == 0
    changed = out.filter(~F.col("is_current")).count()
    assert changed == out.filter((F.col("c_custkey") % 10 == 3)).count() / 2


def test_scd2_twice_is_noop(spark):
    keys = ["c_custkey"]
    s2 = FX.customer_snapshot_2(spark, SF001)
    once = QUERIES["scd2_apply"](spark, SF001)
    twice = H.scd2_apply(once, s2, keys, C.NEXT_LOAD_TS, C.NEXT_BATCH_ID)
    assert _rows(once) == _rows(twice)


def test_dedup_matches_bruteforce(spark):
    df = spark.createDataFrame(
        [(1, "h1", 3, "k3", "x"), (1, "h1", 1, "k9", "y"), (1, "h1", 1, "k2", "z"), (1, "h2", 5, "k1", "w"),
         (2, "h1", 2, "k1", "v")], "id int, h string, t int, k string, payload string")
    got = _rows(H.dedup_earliest(df, ["id", "h"], ["t", "k"]))
    pdf = df.toPandas().sort_values(["t", "k"]).groupby(["id", "h"], as_index=False).first()
    want = sorted(tuple(r) for r in pdf[sorted(pdf.columns)].itertuples(index=False))
    assert got == want


def test_soft_delete_flags_missing_keys(spark):
    out = QUERIES["soft_delete_mark"](spark, SF001)
    r = out.agg(F.count_if("_bronze_is_deleted").alias("d"),
                F.count_if(F.col("_bronze_is_deleted") & (F.col("c_custkey") % 10 != 7)).alias("wrong")).first()
    assert r.d > 0 and r.wrong == 0


def test_cdc_events_replay_to_snapshot(spark):
    ev = QUERIES["cdc_events"](spark, SF001)
    ops = dict(ev.groupBy("operation").count().collect())
    assert set(ops) == {"I", "U", "D"}
    final = QUERIES["stream_cdc_apply"](spark, SF001)
    assert _rows(final) == _rows(FX.customer_snapshot_2(spark, SF001))


def test_incremental_watermark_only_newer(spark):
    inc = QUERIES["incremental_watermark"](spark, SF001)
    assert inc.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).count() == 0
    assert inc.count() > 0


def test_scd2_collapses_duplicate_incoming_keys(spark):
    keys = ["c_custkey"]
    s1 = FX.customer_snapshot_1(spark, SF001)
    hist = H.scd2_initial(s1, keys, C.LOAD_TS, C.BATCH_ID)
    dup = s1.unionByName(s1).unionByName(s1)      # every key three times
    out = H.scd2_apply(hist, dup, keys, C.NEXT_LOAD_TS, C.NEXT_BATCH_ID)
    assert _rows(out) == _rows(hist)


def test_incremental_load_keeps_its_watermark(spark, tmp_path):
    from strata.plans.runs import incremental_load, stored_watermark
    target, state = str(tmp_path / "events"), str(tmp_path / "wm")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    first = incremental_load(spark, ev.filter(F.col("ts") < cut), "ts", target, state, "L1")
    assert first == ev.filter(F.col("ts") < cut).count()
    wm1 = stored_watermark(spark, state)
    assert wm1 == ev.filter(F.col("ts") < cut).agg(F.max("ts").cast("string")).first()[0]
    second = incremental_load(spark, ev, "ts", target, state, "L2")     # the full table arrives again
    assert second == ev.filter(F.col("ts") > F.lit(wm1).cast("timestamp_ntz")).count()
    again = incremental_load(spark, ev, "ts", target, state, "L2")      # a rerun of L2 rewrites L2 only
    assert again == second
    loaded = spark.read.parquet(target)
    assert loaded.count() == ev.count() and loaded.select("event_id").distinct().count() == \
        ev.select("event_id").distinct().count()
    assert incremental_load(spark, ev, "ts", target, state, "L3") == 0     # nothing new
    assert stored_watermark(spark, state) == ev.agg(F.max("ts").cast("string")).first()[0]
    # the increment filter is a literal that reaches the scan
    plan = ev.filter(F.col("ts") > F.lit(wm1).cast("timestamp_ntz"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def _rebuilt(loads, keys):
    """Versions of every key from all loads in the order of their times, by a plain loop."""
    out, current = [], {}
    for t, batch, rows in sorted(loads):
        for r in rows:
            k, content = r[:keys], r[keys:]
            if k not in current or current[k][0] != content:
                if k in current:
                    out.append((*k, *current[k][0], *current[k][1:], t, False))
                current[k] = (content, t, batch)
    return sorted(out + [(*k, *c[0], *c[1:], None, True) for k, c in current.items()], key=repr)


def test_loads_in_any_order_give_one_history(spark):
    import itertools
    import random
    rng = random.Random(4)
    loads = [(f"2024-0{m}-01 00:00:00", f"b{m}", [(k, rng.choice([None, "x", "y"])) for k in range(40) if rng.random() < 0.7]) for m in range(1, 5)]
    orders = [(0, 1, 2, 3), (3, 2, 1, 0), (1, 3, 0, 2), (2, 0, 3, 1)] + rng.sample(list(itertools.permutations(range(4))), 2)
    for order in orders:
        runs, known = None, []
        for n in order:
            t, batch, rows = loads[n]
            df = spark.createDataFrame(rows, "k int, v string")
            runs = H.runs_initial(df, ["k"], t, batch) if runs is None else H.runs_insert(runs, df, ["k"], t, batch, known)
            runs = spark.createDataFrame(runs.collect(), runs.schema)
            known.append((t, batch))
            got = H.runs_versions(runs, ["k"]).withColumn("valid_from", F.col("valid_from").cast("string")).withColumn(
                "valid_to", F.col("valid_to").cast("string")).select("k", "v", "valid_from", "batch_id", "valid_to", "is_current").collect()
            assert sorted((tuple(r) for r in got), key=repr) == _rebuilt([loads[m] for m in order[: len(known)]], 1)
    try:
        H.runs_insert(runs, df, ["k"], loads[0][0], "again", known)
    except ValueError:
        return
    raise AssertionError("a known load time must be refused")


def test_versions_of_late_loads_neither_overlap_nor_run_backwards(spark):
    from pyspark.sql import Window
    out = QUERIES["scd2_late_load"](spark, SF001)
    following = F.lead("valid_from").over(Window.partitionBy("c_custkey").orderBy("valid_from"))
    odd = out.withColumn("next", following).filter((F.col("valid_to") <= F.col("valid_from")) | ~F.col("valid_to").eqNullSafe(F.col("next")))
    assert odd.isEmpty() and out.filter("is_current").count() == out.select("c_custkey").distinct().count()
    assert out.groupBy("c_custkey").count().agg(F.max("count")).first()[0] == 4


def test_scd2_refuses_a_load_out_of_order(spark):
    import pytest
    keys, rows = ["k"], spark.createDataFrame([(1, "a")], "k int, v string")
    hist = H.scd2_initial(rows, keys, "2024-03-01 00:00:00", "b")
    with pytest.raises(Exception, match="out of order"):
        H.scd2_apply(hist, rows, keys, "2024-02-01 00:00:00", "late").collect()


def test_history_plans_shuffle_little(spark):
    """No sort aggregate over text; soft delete reads the bronze rows for its keys and once for the rows."""
    for name, sort_aggregates in (("scd2_apply", 0), ("cdc_events", 0)):
        df = QUERIES[name](spark, SF001)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("SortAggregate") == sort_aggregates

"""Plan-shape tests: the properties that matter at scale, checked on the
physical plan rather than on timings."""

import re

from pyspark.sql import functions as F

from strata import contracts as C
from strata.operators import history as H, quality as Q
from strata.plans.registry import QUERIES

from .conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_and_filter_reach_the_scan(spark):
    plan = _plan(QUERIES["scan_projected"](spark, SF001))
    assert re.search(r"FileScan parquet \[o_orderkey#\d+L,o_custkey#\d+L,o_orderstatus#\d+,o_totalprice#\d+,"
                     r"o_orderdate#\d+\]", plan)
    assert "o_orderpriority" not in plan
    plan = _plan(QUERIES["incremental_watermark"](spark, SF001))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThan\(ts,", plan)


def test_current_row_filter_is_pushed(spark):
    from strata.plans.medallion import CustomerFlow
    from strata.operators import silver as S
    b = CustomerFlow(spark, SF001).bronze()
    plan = _plan(S.current_rows(b))
    assert "Filter" in plan


def test_dedup_aggregates_partially_without_windows(spark):
    plan = _plan(QUERIES["dedup_row_hash"](spark, SF001))
    assert "partial_min" in plan and "Window" not in plan


def test_fk_checks_shuffle_each_key_once(spark):
    """Per relationship one count of child keys and one distinct of parent
    keys, joined on the key itself."""
    plan = _plan(QUERIES["dq_foreign_keys"](spark, SF001))
    assert "partial_count" in plan and "table_name" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", plan))
    assert plan.count("hashpartitioning") <= 2 * len(C.FOREIGN_KEYS)


def test_fk_keys_of_any_type(spark):
    child = spark.createDataFrame([("a", 1), ("a", 1), ("x", 2), (None, 3)], "k string, n int")
    parent = spark.createDataFrame([("a", 1), ("b", 5)], "pk string, pn bigint")
    assert Q.orphan_rows(child, ["k"], parent, ["pk"]).first()[0] == 1
    assert Q.orphan_rows(child, ["n"], parent, ["pn"]).first()[0] == 2
    assert Q.orphan_rows(child, ["k", "n"], parent, ["pk", "pn"]).first()[0] == 1
    assert Q.orphan_rows(child, ["k"], parent, ["pn"]).first()[0] == 3      # text against numbers: compared as text
    assert Q.is_unique(parent, ["pk"]).first()[0] and not Q.is_unique(child, ["k"]).first()[0]


def test_scd2_collapses_incoming_before_full_outer_join(spark):
    """A key is one row there: keys of several rows are found beforehand, by an aggregate that combines before its shuffle."""
    from strata.operators import history as H
    assert "FullOuter" in _plan(QUERIES["scd2_apply"](spark, SF001))
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "c")], "k int, v string")
    assert "partial_count" in _plan(H.faulty_keys(rows, ["k"]))
    joined = _plan(H.scd2_apply(H.scd2_initial(spark.createDataFrame([(9, "z")], "k int, v string"), ["k"], "2024-01-01", "b"), rows, ["k"], "2024-02-01", "c"))
    assert "FullOuter" in joined and "partial_count" in joined


def test_no_python_udfs_in_any_plan(spark):
    for name in ("silver_clean", "dim_customer", "kpi_customer_summary", "record_hash_sha256", "scd2_apply"):
        plan = _plan(QUERIES[name](spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_hot_key_holding_a_third_of_rows(spark):
    """One key holds a third of all rows: duplicate, uniqueness and FK
    checks and de-duplication stay exact."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 5).alias("v"))
    dups = Q.duplicates(df, ["k"]).collect()
    assert [(r.k, r.occurrences) for r in dups] == [(7, n // 3 + 1)]
    u = Q.uniqueness(df, "t", ["k"]).first()
    assert u.failures == n // 3 and u.total_rows == n
    parents = spark.range(n).select(F.col("id").alias("pk"))
    assert Q.orphan_report({"c": df, "p": parents}, [("c", "k", "p", "pk")]).first().orphan_rows == 0
    gone = {"c": df, "p": parents.filter(F.col("pk") != 7)}
    assert Q.orphan_report(gone, [("c", "k", "p", "pk")]).first().orphan_rows == n // 3 + 1
    d = H.dedup_earliest(df.withColumn("t", F.col("v")), ["k"], ["t"])
    assert d.filter(F.col("k") == 7).first().t == 0 and d.count() == n - n // 3


def test_recommended_conf_scales_with_input():
    from strata.session import recommended_conf
    small = recommended_conf(10 << 20, 8)
    big = recommended_conf(100 << 40, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert recommended_conf(1 << 40, 1000)["spark.sql.shuffle.partitions"] == str((1 << 40) // (128 << 20))
    assert big["spark.sql.shuffle.partitions"] == "50000"   # one per split would be 800,000, of as many maps


def test_local_frame_is_a_sized_local_relation(spark):
    import datetime as dt
    from strata.sources.tables import local_frame
    ddl = "name string, n bigint, at timestamp_ntz, ok boolean, x double"
    rows = [("a", 1, dt.datetime(2024, 1, 2, 3, 4, 5), True, 0.5), ("b", None, None, None, None),
            {"name": "c", "n": 3, "at": None, "ok": False, "x": 1.5}]
    df = local_frame(spark, rows, ddl)
    assert df.schema.simpleString() == "struct<name:string,n:bigint,at:timestamp_ntz,ok:boolean,x:double>"
    assert [tuple(r) for r in df.orderBy("name").collect()] == [
        ("a", 1, dt.datetime(2024, 1, 2, 3, 4, 5), True, 0.5), ("b", None, None, None, None),
        ("c", 3, None, False, 1.5)]
    plan = df._jdf.queryExecution().optimizedPlan()
    assert plan.toString().startswith("LocalRelation")
    assert 0 < int(str(plan.stats().sizeInBytes())) < 10_000     # a size the planner can check
    empty = local_frame(spark, [], ddl)
    assert empty.count() == 0 and empty.schema == df.schema


def test_cluster_session_keeps_the_cluster_shuffle_width(monkeypatch):
    """build_session sets a shuffle width only for local mode (or when asked)."""
    from strata import session as SS
    seen = {}

    class Builder:
        def master(self, m):
            seen["master"] = m
            return self

        def appName(self, n):
            return self

        def config(self, k, v):
            seen[k] = v
            return self

        def getOrCreate(self):
            class S:
                class sparkContext:
                    @staticmethod
                    def setLogLevel(level):
                        pass
            return S()

    class FakeSession:
        builder = Builder()

    monkeypatch.setattr(SS, "SparkSession", FakeSession)
    SS.build_session(master="yarn")
    assert "spark.sql.shuffle.partitions" not in seen and "spark.driver.memory" not in seen
    seen.clear()
    SS.build_session(master="yarn", shuffle_partitions=4000)
    assert seen["spark.sql.shuffle.partitions"] == "4000"
    seen.clear()
    SS.build_session(master="local[4]")
    assert seen["spark.sql.shuffle.partitions"] == "8"


def test_salted_join_equals_plain_join_with_a_hot_key(spark):
    """A third of the left rows share one key, some of them exact duplicates:
    the salted join spreads them and returns exactly the plain join."""
    from strata.operators.skew import hot_keys, salted_join
    n = 9000
    left = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
        F.when(F.col("id") % 6 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))   # duplicates on key 7
    right = spark.range(0, 1000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    hot = {r.k: r._salts for r in hot_keys(left, ["k"], 500).collect()}
    assert hot == {7: 7}                                   # 3000 + 3 rows on key 7 -> 7 salts of <= 500
    for how in ("left", "inner"):
        plain = left.join(right, "k", how)
        salted = salted_join(left, right, ["k"], how, max_key_rows=500)
        assert sorted(map(tuple, salted.select("k", "v", "w").collect())) == \
            sorted(map(tuple, plain.select("k", "v", "w").collect()))
    # the salts of the hot key are deterministic and all used
    sal = salted_join(left, right, ["k"], "left", max_key_rows=500)
    assert sal.count() == n
    q = QUERIES["soft_delete_mark"](spark, SF001)
    assert "_salt" in _plan(q) and "_salt" not in q.columns


def test_salted_join_spreads_the_hot_key_over_tasks(spark):
    """Rows per join task, read with spark_partition_id: without salting the
    hot key's rows sit in one task; with salting no task holds half of them."""
    from strata.operators.skew import salted_join
    n = 12000
    left = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 2000).alias("k"), F.col("id").alias("v"))
    right = spark.range(2000).select(F.col("id").alias("k"), F.lit(True).alias("present"))
    hot_rows = left.filter("k = 7").count()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.enabled": "false"}
    saved = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)

        def busiest(df):
            return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

        assert busiest(left.join(right, "k", "left")) >= hot_rows
        salted = salted_join(left, right, ["k"], "left", max_key_rows=hot_rows // 16)
        assert salted.count() == n
        assert busiest(salted) < hot_rows / 2
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_workspace_follows_the_session_checkpoint_dir():
    """Layer tables and stream state go under spark.checkpoint.dir; a cluster
    session without one is refused; only local mode gets its own folder."""
    import pytest
    from strata.session import workspace_root

    class Conf:
        def __init__(self, d):
            self.d = d

        def get(self, k, default=None):
            return self.d.get(k, default)

    def fake(master, conf):
        class SC:
            pass
        sc = SC()
        sc.master = master
        sc.getConf = lambda: Conf(conf)
        sc.setCheckpointDir = lambda p: conf.setdefault("_set", p)

        class S:
            pass
        s = S()
        s.sparkContext = sc
        s.conf = Conf({})
        return s

    shared = fake("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ck/"})
    assert workspace_root(shared) == "hdfs:///shared/ck/strata"
    with pytest.raises(RuntimeError):
        workspace_root(fake("yarn", {}))
    conf = {}
    local = workspace_root(fake("local[2]", conf))
    assert local.endswith("/strata") and "_set" in conf     # its own folder, also the RDD checkpoint dir

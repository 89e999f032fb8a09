"""Second runs, odd keys and folder tables: cases that the driver tables don't hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata import contracts as C
from strata.functions.parsing import parse_iso_datetime
from strata.operators import catalog as CAT, dlq as DLQ, history as H, quality as Q
from strata.plans import medallion as M, registry as REG, runs as RUN
from strata.session import scratch_dir
from strata.sources import sinks

from .conftest import SF001


def test_batch_rerun_leaves_nothing_behind(spark):
    path = scratch_dir(spark, "rerun")
    df = spark.createDataFrame([(1, "b1"), (2, "b1")], "x int, batch_id string")
    assert sinks.write_batch(df, path, "batch_id", "b1") == 2
    sinks.write_batch(df.withColumn("batch_id", F.lit("b2")), path, "batch_id", "b2")
    assert sinks.write_batch(df.limit(0), path, "batch_id", "b1") == 0
    assert [(r.x, r.batch_id) for r in spark.read.parquet(path).orderBy("x").collect()] == [(1, "b2"), (2, "b2")]
    only = spark.read.option("basePath", path).parquet(sinks.batch_path(path, "batch_id", "b1"))
    assert only.count() == 0 and only.columns == ["x", "batch_id"]


def test_replace_drops_old_partitions(spark):
    path = scratch_dir(spark, "replace")
    sinks.write_table(spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string"), path, "replace", partition_by="p")
    sinks.write_table(spark.createDataFrame([(3, "y")], "a int, p string"), path, "replace", partition_by="p")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "y")]


def test_folder_and_file_tables_are_found(spark):
    folder = scratch_dir(spark, "tables")
    df = spark.range(100).withColumnRenamed("id", "k")
    df.repartition(3).write.parquet(f"{folder}/parts.parquet")
    df.coalesce(1).write.parquet(f"{folder}/raw")
    fs_cls = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = fs_cls.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(fs_cls.Path(f"{folder}/raw")) if f.getPath().getName().startswith("part-"))
    fs.rename(part, fs_cls.Path(f"{folder}/single.parquet"))
    found = {r.table_name: r.size_bytes for r in CAT.list_tables(spark, folder).collect()}
    assert found.keys() == {"parts", "single"} and min(found.values()) > 0
    assert {(r.table_name, r.row_count) for r in CAT.discover(spark, folder).collect()} == {("parts", 100), ("single", 100)}
    audit = RUN.RunAudit("parquet", "b")
    RUN.ingest_all(spark, folder, RUN.parquet_reader(spark, folder), scratch_dir(spark, "lake"), C.LOAD_TS, audit)
    assert audit.total_rows() == 200 and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    with pytest.raises(ValueError):
        audit.add(RUN.TableSpec("t"), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), 0, "fine")


def test_history_with_null_and_ambiguous_keys(spark):
    ddl = "k int, a string, b string"
    first = spark.createDataFrame([(None, "n1", "x"), (1, "a|b", "c"), (2, "p", None), (3, "s", "s")], ddl)
    hist = H.scd2_initial(first, ["k"], C.LOAD_TS, "b1")
    second = spark.createDataFrame([(None, "n1", "x"), (1, "a", "b|c"), (2, "p", "None"), (3, "s", "s"), (4, "u", "v"), (4, "w", "v"), (5, "z", "z"), (5, "z", "z")], ddl)
    out = H.scd2_apply(hist, second, ["k"], C.NEXT_LOAD_TS, "b2")
    got = sorted(((r.k or 0, r.a, r.b or "", r.is_current) for r in out.collect()))
    assert got == [(0, "n1", "x", True), (1, "a", "b|c", True), (1, "a|b", "c", False), (2, "p", "", False), (2, "p", "None", True), (3, "s", "s", True), (5, "z", "z", True)]
    bad = sorted((r.k or 0, r.a, r.key_fault) for r in H.unusable(second, ["k"]).collect())
    assert bad == [(0, "n1", "null_key"), (4, "u", "ambiguous_key"), (4, "w", "ambiguous_key")]
    again = H.scd2_apply(out, second, ["k"], C.NEXT_LOAD_TS, "b3")
    assert again.count() == out.count()
    events = {(r.operation, r.record_key) for r in H.change_events(first, second, ["k"], "t", C.LOAD_TS).collect()}
    assert events == {("U", 1), ("U", 2), ("I", 5)}
    pair = H.change_events(first.dropna(), second.dropna(), ["k", "a"], "t", C.LOAD_TS)
    assert ("D", '{"k":1,"a":"a|b"}') in {(r.operation, r.record_key) for r in pair.collect()}


def test_ambiguous_known_keys_give_no_event(spark):
    ddl = "k int, a string"
    old = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y"), (3, "x"), (4, "x"), (4, "x"), (5, "p"), (5, "q"), (6, "x"), (None, "x")], ddl)
    new = spark.createDataFrame([(1, "x"), (1, "z"), (2, "x"), (4, "w"), (5, "p"), (5, "r"), (6, "x"), (7, "x"), (8, "x"), (8, "y"), (None, "y")], ddl)
    events = {(r.operation, r.record_key) for r in H.change_events(old, new, ["k"], "t", C.LOAD_TS).collect()}
    assert events == {("D", 3), ("U", 4), ("I", 7)}
    lake = scratch_dir(spark, "lake")
    for _ in range(2):  # a rerun replaces its own batch
        assert RUN.set_aside(old, ["k"], "t", lake, "b1")[0] == 5 and RUN.set_aside(new, ["k"], "t", lake, "b2")[0] == 7
    stored = spark.read.parquet(f"{lake}/silver/key_errors/t")
    assert sorted((r.batch_id, r.k or 0, r.a, r.key_fault) for r in stored.filter("batch_id = 'b1'").collect()) == [
        ("b1", 0, "x", "null_key"), ("b1", 2, "x", "ambiguous_key"), ("b1", 2, "y", "ambiguous_key"), ("b1", 5, "p", "ambiguous_key"), ("b1", 5, "q", "ambiguous_key")]


@pytest.mark.parametrize("name, batches", [("scd2_apply", {"batch_002"}), ("cdc_events", {"batch_001", "batch_002"}), ("stream_cdc_apply", {"batch_001", "batch_002"})])
def test_history_queries_write_quarantine(spark, monkeypatch, name, batches):
    rows = spark.createDataFrame([(1, "n", 1, 1.0, "s"), (1, "m", 1, 1.0, "s"), (2, "n", 1, 1.0, "s")], REG.CUSTOMER_ROW)
    for snapshot in ("customer_snapshot_1", "customer_snapshot_2"):
        monkeypatch.setattr(REG.FX, snapshot, lambda spark, sf_dir: rows)
    lake = scratch_dir(spark, "lake")
    monkeypatch.setattr(REG, "scratch_dir", lambda spark, purpose: f"{lake}/{name}")
    REG.QUERIES[name](spark, SF001).collect()
    stored = spark.read.parquet(f"{lake}/{name}/silver/key_errors/customer").collect()
    assert sorted((r.batch_id, r.c_name) for r in stored) == sorted((b, n) for b in batches for n in "nm")


def test_soft_delete_and_inactivation_keep_first_dates(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, v string")
    one = H.soft_delete(rows, rows.filter("k <> 2"), ["k"], "2024-01-01 00:00:00")
    two = H.soft_delete(one, rows.filter("k = 1"), ["k"], "2024-02-01 00:00:00")
    got = sorted((r.v, r._bronze_is_deleted, str(r._bronze_deleted_at)[:10]) for r in two.collect())
    assert got == [("a", False, "None"), ("a", False, "None"), ("b", True, "2024-01-01"), ("c", True, "2024-01-01"), ("d", True, "2024-02-01")]
    back = H.soft_delete(two, rows, ["k"], "2024-03-01 00:00:00")
    assert not any(r._bronze_is_deleted for r in back.filter("k is not null").collect())
    off = H.inactivate(rows, rows.filter("k <> 2"), ["k"], "2024-01-01", "first")
    off = H.inactivate(off, rows.filter("k = 1"), ["k"], "2024-02-01", "second")
    assert off.columns == ["k", "v", "is_active", "inactivated_date", "inactivated_by"]
    assert {(r.v, str(r.inactivated_date), r.inactivated_by) for r in off.filter("not is_active").collect()} == {
        ("b", "2024-01-01", "first"), ("c", "2024-01-01", "first"), ("d", "2024-02-01", "second")}


def test_offsets_name_instants(spark):
    texts = ["2022-02-15T09:57:20+05:30", "2022-02-15T09:57:20Z", "2022-02-15T00:10-01:00", "2022-02-15", "2022-02-15T09:57:20"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_iso_datetime("t").cast("string").alias("w"))
    assert [r.w for r in df.collect()] == ["2022-02-15 04:27:20", "2022-02-15 09:57:20", "2022-02-15 01:10:00", "2022-02-15 00:00:00", "2022-02-15 09:57:20"]


def test_fractional_ids_are_dead_letters(spark):
    df = spark.createDataFrame([("1", "a@b"), ("1.5", "a@b"), ("X1", "a@b"), (None, "a@b")], "customer_id string, email string")
    bad = DLQ.dlq_rows(DLQ.checked(df), "customer", "b").collect()
    assert sorted((r.actual_value, r.expected_type) for r in bad) == [("1.5", "integer"), ("None", "integer")]


def test_unreadable_values_are_not_replaced_by_defaults(spark, monkeypatch):
    names = [c.name for c in C.ORDERS_TYPED.columns]
    rows = [("1", "10", "F", "12.50", "1995-01-01 00:00:00", "1-URGENT"), ("2", "10", None, None, None, None),
            ("3", "x", "F", "12,50", "1995-13-01", "1-URGENT")]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    monkeypatch.setattr(REG, "table", lambda spark, sf_dir, name: df)
    lake = scratch_dir(spark, "lake")
    monkeypatch.setattr(REG, "scratch_dir", lambda spark, purpose: lake)
    got = {r.o_orderkey: r for r in REG.QUERIES["bronze_typed_conform"](spark, SF001).collect()}
    assert [str(got[k].o_totalprice) for k in (1, 2, 3)] == ["12.50", "0.00", "None"]
    assert (got[2].o_orderstatus, got[2].o_orderpriority, got[2].source_o_orderdate) == ("O", "5-LOW", None)
    bad = spark.read.parquet(f"{lake}/bronze/unreadable/orders").collect()
    assert sorted((r.batch_id, r.failed_field, r.actual_value, r.expected_type) for r in bad) == [
        (C.BATCH_ID, "o_custkey", "x", "bigint"), (C.BATCH_ID, "o_orderdate", "1995-13-01", "timestamp_ntz"),
        (C.BATCH_ID, "o_totalprice", "12,50", "decimal(12,2)")]
    assert all('"o_orderkey":"3"' in r.raw_record for r in bad)


def test_validate_stage_sees_a_broken_layer(spark):
    run = M.run_medallion(spark, SF001, scratch_dir(spark, "lake"))
    assert run["valid"]
    path = run["paths"]["sl_customer"]
    stored = spark.read.parquet(path)
    rows = stored.collect()
    sinks.write_batch(spark.createDataFrame(rows[1:], stored.schema), path, "sl_batch_id", run["batch_id"])
    failed = {r.check_name for r in M.validate_layers(spark, SF001, run).collect() if not r.ok}
    assert failed == {"bronze_vs_silver_quarantine", "silver_vs_dim"}
    with pytest.raises(M.ValidationFailed) as stopped:
        M.validated_run(spark, SF001, run)
    report = {r.table_name: (r.checks_failed, r.run_valid) for r in M.run_summary(spark, stopped.value.run).collect()}
    assert report["sl_customer"] == (1, False) and report["dim_customer"] == (1, False) and report["dim_date"] == (0, False)


def test_everything_quarantined_is_a_valid_batch(spark):
    path = scratch_dir(spark, "empty_silver")
    empty = spark.createDataFrame([], "customer_id bigint, sl_batch_id string")
    sinks.write_batch(empty, path, "sl_batch_id", "b1")
    assert M._read_batch(spark, path, "sl_batch_id", "b1").count() == 0


def test_checks_scan_a_table_once(spark):
    df = spark.read.parquet(f"{SF001}/customer.parquet")
    for out in (Q.completeness(df, "customer", ("c_custkey", "c_name", "nope")), Q.nulls_in(df, "customer", ("c_custkey", "c_name"), "x")):
        rows = out.collect()
        assert len(rows) in (2, 3)
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Scan parquet") == 1

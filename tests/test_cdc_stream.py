"""Change events applied over several micro-batches, out of order, after a restart and after a compaction."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from strata import contracts as C
from strata.operators import history as H
from strata.plans import fixtures as FX
from strata.streaming import cdc_stream as CDC

from .conftest import SF001

ROW = (StructType().add("c_custkey", "long").add("c_name", "string").add("c_nationkey", "integer").add("c_acctbal", "double")
       .add("c_mktsegment", "string"))
KEY = ["c_custkey"]
T0 = dt.datetime(2024, 1, 1)


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def _event(op, row, seconds, seq=0, key=None):
    key = str(next(iter(row.values()))) if key is None else key
    return ("t", op, key, json.dumps(row), T0 + dt.timedelta(seconds=seconds), seq)


def test_multi_batch_apply_and_restart(spark, tmp_path):
    base = str(tmp_path)
    s1 = FX.customer_snapshot_1(spark, SF001)
    s2 = FX.customer_snapshot_2(spark, SF001)
    s3 = s2.filter(F.col("c_nationkey") != 3)            # a later extract: one nation's customers deleted
    CDC.init_state(s1, f"{base}/state")
    assert _rows(CDC.current(spark, f"{base}/state", KEY, ROW)) == _rows(s1)
    # the later events arrive first
    CDC.publish(H.change_events(s2, s3, KEY, "customer", "2024-03-01 00:00:00").coalesce(1), f"{base}/events")

    def run():
        CDC.start_apply_stream(spark, f"{base}/events", f"{base}/state", KEY, ROW, max_files=1).awaitTermination()

    run()
    CDC.publish(H.change_events(s1, s2, KEY, "customer", C.NEXT_LOAD_TS).coalesce(1), f"{base}/events")
    run()
    assert _rows(CDC.current(spark, f"{base}/state", KEY, ROW)) == _rows(s3)
    n = CDC.running(spark, f"{base}/state", KEY, ROW).count()
    CDC.publish(H.change_events(s1, s2, KEY, "customer", C.NEXT_LOAD_TS).coalesce(1), f"{base}/events")
    run()   # restart with events that were there before
    assert CDC.running(spark, f"{base}/state", KEY, ROW).count() == n and _rows(CDC.current(spark, f"{base}/state", KEY, ROW)) == _rows(s3)
    # consumers get every changed key's latest row per micro-batch; a read needs neither those nor the events
    changed = spark.read.parquet(f"{base}/state/changed")
    assert changed.select("epoch").distinct().count() == 3 and changed.groupBy("epoch", *KEY).count().filter("count > 1").isEmpty()
    read = CDC.current(spark, f"{base}/state", KEY, ROW)
    files = read.inputFiles()
    assert files and all("/state/base/" in f for f in files)
    assert "storeName=default" in read._jdf.queryExecution().executedPlan().toString()
    CDC.compact(spark, f"{base}/state", f"{base}/compact", KEY, ROW)
    assert _rows(CDC.current(spark, f"{base}/compact", KEY, ROW)) == _rows(s3)
    # events older than the tombstones still lose after the compaction
    CDC.publish(H.change_events(s1.limit(0), s1, KEY, "customer", C.LOAD_TS), f"{base}/late")
    CDC.start_apply_stream(spark, f"{base}/late", f"{base}/compact", KEY, ROW).awaitTermination()
    assert _rows(CDC.current(spark, f"{base}/compact", KEY, ROW)) == _rows(s3)


def test_same_time_events_follow_their_sequence(spark):
    row = _parse_datatype_string("k string, v bigint")
    ev = [_event("U", {"k": "a", "v": 1}, 5, 0), _event("D", {"k": "a", "v": 1}, 5, 1),       # update, then delete
          _event("D", {"k": "b", "v": 1}, 5, 0), _event("I", {"k": "b", "v": 2}, 5, 1),       # delete, then insert
          _event("U", {"k": "c", "v": 9}, 9), _event("U", {"k": "c", "v": 3}, 3),             # late
          _event("D", {"k": "d", "v": 1}, 5), _event("U", {"k": "d", "v": 2}, 5)]             # one time and sequence: the delete wins
    events = spark.createDataFrame(ev, CDC.EVENT_SCHEMA)
    for order in (events, events.orderBy(F.desc("event_ts"), F.desc("event_seq"))):
        got = {r.k: (r._deleted, r.v) for r in CDC.latest(CDC.log_rows(order, ["k"], row), ["k"]).collect()}
        assert got == {"a": (True, 1), "b": (False, 2), "c": (False, 9), "d": (True, 1)}


def test_keys_of_several_columns_and_events_without_one(spark):
    row = _parse_datatype_string("k1 string, k2 int, v bigint")
    ev = [_event("I", {"k1": "a", "k2": 1, "v": 1}, 1), _event("U", {"k1": "a", "k2": 2, "v": 2}, 1),
          _event("U", {"k1": "a", "k2": 1, "v": 3}, 2), _event("U", {"k1": "a", "k2": None, "v": 4}, 3), ("t", "U", None, None, None, None)]
    rows = CDC.log_rows(spark.createDataFrame(ev, CDC.EVENT_SCHEMA), ["k1", "k2"], row)
    assert sorted((r.k1, r.k2, r.v) for r in CDC.latest(rows, ["k1", "k2"]).collect()) == [("a", 1, 3), ("a", 2, 2)]
    # a delete that carries no row names its key by itself
    one = _parse_datatype_string("k bigint, v bigint")
    ev = [_event("I", {"k": 7, "v": 1}, 1), ("t", "D", "7", None, T0 + dt.timedelta(seconds=2), 0)]
    got = CDC.latest(CDC.log_rows(spark.createDataFrame(ev, CDC.EVENT_SCHEMA), ["k"], one), ["k"]).collect()
    assert [(r.k, r._deleted) for r in got] == [(7, True)]


def test_events_that_cannot_be_read_change_nothing(spark, tmp_path):
    """They go to quarantine as they came, lines that are no events included; a row they name stays."""
    row = _parse_datatype_string("k bigint, bal double, name string")
    path = str(tmp_path)
    CDC.init_state(spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "c")], row), f"{path}/state")
    at = T0 + dt.timedelta(seconds=9)
    events = [("t", "U", "1", "not json", at, 0), ("t", "U", "1", '{"k":1,"bal":"abc"}', at, 0), ("t", "U", "1", "[1]", at, 0), ("t", "U", "1", None, at, 0),
              ("t", "D", "9x", None, at, 0), ("t", "U", "1", '{"bal":1.0}', at, 0), ("t", None, "1", '{"k":1}', at, 0), ("t", "U", "1", '{"k":1}', None, 0),
              ("t", "U", "2", '{"k":2,"bal":7.5}', at, None), ("t", "D", "3", "not json", at, 0)]
    CDC.publish(spark.createDataFrame(events, CDC.EVENT_SCHEMA).coalesce(1), f"{path}/events")
    (tmp_path / "events" / "odd.json").write_text("half a li\n")
    for start in (CDC.start_apply_stream, CDC.start_fault_stream):
        for _ in range(2):
            start(spark, f"{path}/events", f"{path}/state", ["k"], row, max_files=1).awaitTermination()
    assert _rows(CDC.current(spark, f"{path}/state", ["k"], row)) == [(1.0, 1, "a"), (7.5, 2, None)]
    found = [(r.fault, r.data) for r in CDC.stored_faults(spark, f"{path}/state").collect()]
    assert sorted(found, key=repr) == sorted([("unreadable_data", "not json"), ("unreadable_data", '{"k":1,"bal":"abc"}'), ("unreadable_data", "[1]"), ("no_data", None),
                                              ("no_key", None), ("no_key", '{"bal":1.0}'), ("unknown_operation", '{"k":1}'), ("no_time", '{"k":1}'),
                                              ("unknown_operation", None)], key=repr)
    assert [r[CDC.LINE] for r in CDC.stored_faults(spark, f"{path}/state").filter(f"{CDC.LINE} is not null").collect()] == ["half a li"]


def test_unkeyed_rows_are_kept_apart(spark, tmp_path):
    row = _parse_datatype_string("k bigint, v bigint")
    CDC.init_state(spark.createDataFrame([(1, 1), (None, 2)], "k bigint, v bigint"), f"{tmp_path}/state")
    assert [r.v for r in CDC.unkeyed(spark, f"{tmp_path}/state", ["k"], row).collect()] == [2]
    assert [(r.k, r.v) for r in CDC.current(spark, f"{tmp_path}/state", ["k"], row).collect()] == [(1, 1)]


def test_latest_with_a_hot_key(spark):
    """A third of all events update one key: the aggregate combines before the shuffle and the newest wins."""
    row = _parse_datatype_string("k bigint, v bigint")
    n = 30000
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).cast("bigint")
    ev = spark.range(n).select(
        F.lit("t").alias("table_name"), F.lit("U").alias("operation"), key.cast("string").alias("record_key"),
        F.to_json(F.struct(key.alias("k"), F.col("id").alias("v"))).alias("data"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("event_ts"),
        F.lit(0).cast("bigint").alias("event_seq"))
    out = CDC.latest(CDC.log_rows(ev, ["k"], row), ["k"])
    assert [r.v for r in out.filter("k = 1").collect()] == [n - 3]
    assert out.count() == n - n // 3
    assert "partial_max" in out._jdf.queryExecution().executedPlan().toString()


def test_random_events_match_a_python_replay(spark, tmp_path):
    """Random I/U/D events, streamed in shuffled order, against a replay in time order."""
    rnd = random.Random(7)
    row = _parse_datatype_string("k bigint, v bigint")
    state = {k: k * 10 for k in range(60)}
    path = str(tmp_path)
    CDC.init_state(spark.createDataFrame(sorted(state.items()), "k bigint, v bigint"), f"{path}/state")
    evs = []
    for i in range(160):
        k = rnd.choice([rnd.randrange(90), 3])          # key 3 is hot
        op = rnd.choice("IUD")
        evs.append(_event(op, {"k": k, "v": 1000 + i}, i // 4, i % 4))   # four events a second
        if op == "D":
            state.pop(k, None)
        else:
            state[k] = 1000 + i
    rnd.shuffle(evs)
    for part in range(4):
        CDC.publish(spark.createDataFrame(evs[part::4], CDC.EVENT_SCHEMA).coalesce(1), f"{path}/events")
    CDC.start_apply_stream(spark, f"{path}/events", f"{path}/state", ["k"], row, max_files=1).awaitTermination()
    got = {r.k: r.v for r in CDC.current(spark, f"{path}/state", ["k"], row).collect()}
    assert got == state

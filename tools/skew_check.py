"""Measure how the keyed operators treat a key that holds a third of all rows.

A skewed copy of ``lineitem`` is derived in Spark (every third row gets the
same order key), each operator runs once with the no-op sink, and Spark's
event log (written to a fresh scratch folder) gives, per operator, the
records read from shuffle by the busiest task against all shuffle records.
Map-side combining shows up as a busiest task far below the hot key's share.

A local diagnostic: it runs on local[8] and keeps its event log and the
skewed copy in fresh folders under /tmp.

usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F, types as T  # noqa: E402

from strata.operators import history as H, quality as Q  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata.streaming import cdc_stream as CDC  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="skew-events-", dir="/tmp")
    spark = build_session(master="local[8]", shuffle_partitions=16, app_name="strata-skew",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                                 "spark.eventLog.compress": "false",
                                 # keep the 16 reducers apart: coalescing would merge small partitions
                                 # and hide how keys spread over tasks
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
    hot_key = orders.agg(F.min("o_orderkey")).first()[0]
    # written once as 8 files: several map tasks, as a large input would have,
    # and no shuffle of its own inside the measured jobs
    data = tempfile.mkdtemp(prefix="skew-data-", dir="/tmp")
    li.withColumn("l_orderkey", F.when(hot, F.lit(hot_key)).otherwise(F.col("l_orderkey"))) \
        .repartition(8).write.parquet(f"{data}/lineitem")
    skewed = spark.read.parquet(f"{data}/lineitem")
    total = skewed.count()
    hot_rows = skewed.filter(F.col("l_orderkey") == hot_key).count()
    events = skewed.select(
        F.lit("lineitem").alias("table_name"), F.lit("U").alias("operation"),
        F.col("l_orderkey").cast("string").alias("record_key"), F.lit(0).cast("bigint").alias("event_seq"),
        F.to_json(F.struct(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("v"))).alias("data"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(secs=F.col("l_linenumber"))).alias("event_ts"))
    ops = {
        "Q2 duplicates": lambda: Q.duplicates(skewed, ["l_orderkey"]),
        "Q3 sum_match": lambda: Q.sum_match(orders, skewed),
        "Q4 foreign key": lambda: Q.orphan_report({"lineitem": skewed, "orders": orders},
                                                  [("lineitem", "l_orderkey", "orders", "o_orderkey")]),
        "J3 dedup": lambda: H.dedup_earliest(skewed, ["l_orderkey"], ["l_linenumber"]),
        "J4 soft delete": lambda: H.soft_delete(skewed, orders.withColumnRenamed("o_orderkey", "l_orderkey"),
                                                ["l_orderkey"], "2024-01-01 00:00:00"),
        "K2 CDC latest": lambda: CDC.latest(CDC.log_rows(events, ["k"], T.StructType([
            T.StructField("k", T.LongType()), T.StructField("v", T.DecimalType(15, 2))])), ["k"]),
        # the snapshot side too large to broadcast: a sort-merge left join whose
        # hot partition AQE splits (thresholds scaled down to this data size)
        "J4 sort-merge": lambda: H.soft_delete(skewed, orders.withColumnRenamed("o_orderkey", "l_orderkey"),
                                               ["l_orderkey"], "2024-01-01 00:00:00", max_key_rows=5_000),
    }
    scaled_down = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                   "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
                   "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
    groups = {}
    for name, build in ops.items():
        group = f"skew-{len(groups)}"
        groups[group] = name
        sc.setJobGroup(group, name)
        saved = {k: spark.conf.get(k) for k in scaled_down}
        if name == "J4 sort-merge":
            for k, v in scaled_down.items():
                spark.conf.set(k, v)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        groups[group] = (name, time.perf_counter() - t0)
        for k, v in saved.items():
            spark.conf.set(k, v)
    sc.setJobGroup("done", "done")
    spark.stop()

    # event log: stage -> job group (from job starts), shuffle records read per task
    stage_group, tasks = {}, {}
    for path in glob.glob(f"{logs}/**/*", recursive=True):
        if not os.path.isfile(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    tasks.setdefault(e["Stage ID"], []).append(m.get("Total Records Read", 0))
    print(f"input rows {total}, hot key rows {hot_rows} ({hot_rows / total:.0%})")
    print("busiest / median = shuffle records read by the busiest / the median reducing task of the operator's "
          "widest stage; vs hot key = busiest / hot key rows")
    print(f"{'operator':16s} {'sec':>6s} {'shuffle recs':>13s} {'busiest':>9s} {'median':>9s} {'vs hot key':>11s}")
    for group, (name, secs) in groups.items():
        stages = [rs for sid, rs in tasks.items() if stage_group.get(sid) == group and sum(rs) > 0]
        widest = max(stages, key=sum) if stages else [0]
        top, med = max(widest), sorted(widest)[len(widest) // 2]
        total_recs = sum(sum(rs) for rs in stages)
        print(f"{name:16s} {secs:6.2f} {total_recs:13d} {top:9d} {med:9d} {top / hot_rows:11.1%}")


if __name__ == "__main__":
    main()

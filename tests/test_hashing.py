"""Surrogate keys: different parts give different keys."""

from pyspark.sql import functions as F

from strata.functions.hashing import uuid_from_md5
from strata.session import MOST_SCAN_TASKS, MOST_SHUFFLE_PARTITIONS, recommended_conf


def test_parts_cannot_run_into_each_other(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("-", "x"), ("1:a", "x"), ("a", None), ("a", ""), (None, None), ("None", "x")]
    df = spark.createDataFrame(rows, "a string, b string").select(uuid_from_md5("t", F.col("a"), F.col("b")).alias("k"))
    keys = [r.k for r in df.collect()]
    assert len(set(keys)) == len(rows) and all(len(k) == 36 for k in keys)
    again = spark.createDataFrame(rows, "a string, b string").select(uuid_from_md5("t", F.col("a"), F.col("b")).alias("k"))
    assert [r.k for r in again.collect()] == keys


def test_a_large_cluster_run_has_a_bounded_number_of_blocks():
    conf = recommended_conf(100 << 40, 8000)
    splits = (100 << 40) / int(conf["spark.sql.files.maxPartitionBytes"])
    assert splits <= MOST_SCAN_TASKS and int(conf["spark.sql.shuffle.partitions"]) <= MOST_SHUFFLE_PARTITIONS
    assert recommended_conf(10 << 40, 1000)["spark.sql.files.maxPartitionBytes"] == str(128 << 20)

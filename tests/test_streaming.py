"""Streaming quarantine: restart from the checkpoint does not duplicate."""

from strata import contracts as C
from strata.plans import fixtures as FX
from strata.plans.medallion import CustomerFlow
from strata.streaming import bronze_stream as STREAM

from .conftest import SF001


def test_stream_restart_does_not_duplicate(spark, tmp_path):
    base = str(tmp_path)

    def run():
        stream = STREAM.customer_bronze_stream(spark, SF001,
                                               lambda raw: FX.dirty_rows(raw, STREAM.PLACE))
        q = STREAM.start_quarantine_stream(stream, f"{base}/lake", f"{base}/_ck", C.BATCH_ID, C.LOAD_TS)
        q.awaitTermination()

    run()
    first = spark.read.parquet(f"{base}/lake/silver/sl_transformation_errors").count()
    run()   # same checkpoint: nothing new to process
    assert spark.read.parquet(f"{base}/lake/silver/sl_transformation_errors").count() == first
    expected = CustomerFlow(spark, SF001).quarantine().count()
    assert first == expected
    assert spark.read.parquet(f"{base}/lake/silver/sl_customer").count() == CustomerFlow(spark, SF001).silver().count()


def test_stream_picks_up_only_new_files(spark, tmp_path):
    from pyspark.sql import functions as F
    base = str(tmp_path)
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    first, second = cust.filter(F.col("c_custkey") < 75), cust.filter(F.col("c_custkey") >= 75)
    first.coalesce(1).write.parquet(f"{base}/landing/part1")

    def run():
        stream = STREAM.customer_bronze_stream(
            spark, SF001, lambda raw: FX.dirty_rows(raw, STREAM.PLACE),
            source_dir=f"{base}/landing/*", glob="*.parquet")
        q = STREAM.start_quarantine_stream(stream, f"{base}/lake", f"{base}/_ck", C.BATCH_ID, C.LOAD_TS)
        q.awaitTermination()

    def total():
        s = spark.read.parquet(f"{base}/lake/silver/sl_customer").count()
        e = spark.read.parquet(f"{base}/lake/silver/sl_transformation_errors").count()
        return s + e

    run()
    assert total() == 75
    second.coalesce(1).write.parquet(f"{base}/landing/part2")
    run()
    assert total() == 150
    epochs = {r[0] for r in spark.read.parquet(f"{base}/lake/silver/sl_customer").select("stream_epoch").collect()}
    assert len(epochs) == 2


def test_redelivered_files_add_nothing_and_equal_rows_stay(spark, tmp_path):
    """Bronze is silver and errors together, over several micro-batches, a file delivered twice in one trigger and again later."""
    from strata.sources import sinks
    base = str(tmp_path)
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    cust.unionByName(cust.filter("c_custkey % 10 = 0")).repartition(4).write.parquet(f"{base}/landing")   # some rows twice
    n = 150 + cust.filter("c_custkey % 10 = 0").count()
    assert sinks.copy_files(spark, f"{base}/landing", "twice-") == 4

    def run():
        stream = STREAM.customer_bronze_stream(spark, SF001, lambda raw: FX.dirty_rows(raw, STREAM.PLACE), max_files=3, source_dir=f"{base}/landing", glob="*.parquet")
        STREAM.start_quarantine_stream(stream, f"{base}/lake", f"{base}/_ck", C.BATCH_ID, C.LOAD_TS).awaitTermination()
        return [spark.read.parquet(f"{base}/lake/{t}").count() for t in ("bronze/br_customer", "silver/sl_customer", "silver/sl_transformation_errors")]

    bronze, silver, errors = run()
    assert bronze == n == silver + errors and silver and errors
    sinks.copy_files(spark, f"{base}/landing", "later-")
    assert run() == [bronze, silver, errors]
    for t in ("bronze/br_customer", "silver/sl_customer", "silver/sl_transformation_errors"):
        assert spark.read.parquet(f"{base}/lake/{t}").select("stream_epoch").distinct().count() > 1


def test_a_replayed_micro_batch_replaces_its_folder_whole(spark, tmp_path):
    from strata.sources import sinks
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1,), (2,)], "x int")
    for rows in (df, df.limit(0)):
        sinks.write_batch(rows, sinks.batch_path(path, "batch_id", "b"), STREAM.EPOCH, "0")
    sinks.write_batch(df, sinks.batch_path(path, "batch_id", "b"), STREAM.EPOCH, "1")
    assert spark.read.parquet(path).groupBy("batch_id", STREAM.EPOCH).count().collect() == [("b", 1, 2)]

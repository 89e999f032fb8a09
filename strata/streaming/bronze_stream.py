"""Streaming bronze ingest with replay protection and quarantine.

The file stream gets the bronze audit columns of the batch flow. Rows that were there before are dropped in the state store: a file that is delivered
again, under whatever name, has the same records in the same places, while equal records of one delivery lie in different places and
stay. The state holds what arrived within ``horizon``.

Each micro-batch is evaluated once, into bronze; silver and quarantine are the rules over that stored part of bronze, so bronze is
silver and errors together. Every table has a folder per (batch id, micro-batch) that a micro-batch replaces whole when it is run again after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rules import customer_rules
from ..operators import bronze as B, silver as S
from ..sources import sinks
from ..sources.tables import scan_table

EPOCH = "stream_epoch"
#: A record's place in its file, and when its micro-batch began: never late, however old a file is.
PLACE, ARRIVED = "_place", "_arrived"
HORIZON = "7 days"


def customer_bronze_stream(spark: SparkSession, sf_dir: str, transform, max_files: int | None = 1000,
                           source_dir: str | None = None, glob: str = "customer.parquet") -> DataFrame:
    """Stream customer files from ``source_dir`` (default: the table folder);
    files that land later are picked up by the next trigger. ``max_files``
    bounds a micro-batch (1000 files of ~128 MB is ~128 GB), so a backlog
    runs as several restartable batches rather than one. ``transform`` has to hand on ``PLACE``."""
    schema = scan_table(spark, sf_dir, "customer").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.parquet(source_dir or sf_dir)
    return transform(raw.select("*", F.col("_metadata.row_index").alias(PLACE)))


def new_rows(stream: DataFrame, table: str, batch_id: str, load_ts, key_cols, horizon: str = HORIZON) -> DataFrame:
    """Bronze rows of the stream that did not arrive before within ``horizon``."""
    bronze = B.audit_lenient(B.stringify(stream, carry=(PLACE,)), table, batch_id, load_ts, key_cols=key_cols, carry=(PLACE,))
    return (bronze.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, horizon)
            .dropDuplicatesWithinWatermark(["br_record_hash", PLACE]).drop(ARRIVED, PLACE))


def start_quarantine_stream(stream: DataFrame, lake: str, checkpoint: str, batch_id: str, load_ts,
                            table: str = "customer", available_now: bool = True, horizon: str = HORIZON):
    rules = customer_rules()
    bronze = new_rows(stream, table, batch_id, load_ts, ("customer_id",), horizon)

    def write_micro_batch(batch: DataFrame, epoch: int):
        def write(df, path, part):
            sinks.write_batch(df.drop(part), sinks.batch_path(path, part, batch_id), EPOCH, str(epoch))

        where = f"{lake}/bronze/br_{table}"
        write(batch, where, "br_batch_id")
        mine = sinks.batch_path(sinks.batch_path(where, "br_batch_id", batch_id), EPOCH, str(epoch))
        stored = batch.sparkSession.read.schema(batch.drop("br_batch_id").schema).parquet(mine).withColumn("br_batch_id", F.lit(batch_id))
        v = S.validate(S.current_rows(stored), rules)
        write(S.clean(v, rules, "br_customer_key", batch_id, load_ts), f"{lake}/silver/sl_{table}", "sl_batch_id")
        write(S.quarantine(v, S.SILVER_CUSTOMER_SOURCE, "br_customer_key", batch_id, load_ts), f"{lake}/silver/sl_transformation_errors", "batch_id")

    w = bronze.writeStream.foreachBatch(write_micro_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()

"""The stored run log: what happened to every table of every run, also if the run never came to its end.

Events are appended, one when a table is begun and one when it is finished, as rows of the audit table's columns partitioned by the day of the event. Nothing is
ever rewritten, so runs can log side by side. The state of a run is a fold over its events; a table that was begun by a run of which nothing
more was heard is ``broken_off``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.tables import local_frame

# Columns and statuses of the audit table.
AUDIT_SCHEMA = ("audit_id string, source_system string, source_schema string, source_table string, "
                "target_table string, ingestion_started_at timestamp_ntz, ingestion_completed_at timestamp_ntz, "
                "duration_seconds double, rows_processed bigint, status string, error_message string, batch_id string")
STATUSES = ("running", "success", "failed", "empty")
BROKEN_OFF = "broken_off"
EVENT_SCHEMA = AUDIT_SCHEMA + ", event_at timestamp_ntz, run_id string"


class RunLog:
    """Appends audit rows as events. ``run_id`` tells runs of one batch apart."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark, self.path, self.run_id = spark, path, run_id or uuid.uuid4().hex

    def append(self, entries, at: dt.datetime) -> None:
        rows = local_frame(self.spark, [(*e, at, self.run_id) for e in entries], EVENT_SCHEMA)
        rows.coalesce(1).withColumn("run_date", F.lit(at.date())).write.mode("append").partitionBy("run_date").parquet(self.path)


def events(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """The events, of runs since a day if given (only their folders are read); no rows if there is no log yet."""
    schema = T._parse_datatype_string(EVENT_SCHEMA + ", run_date date")
    try:
        out = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return out if since is None else out.filter(F.col("run_date") >= F.lit(since))


def states(log: DataFrame, as_of: dt.datetime, silent_for: dt.timedelta = dt.timedelta(hours=6)) -> DataFrame:
    """One row per run and table: its last event. A finish counts after a begin of the same time. A table that is still ``running`` is ``broken_off`` if
    its run logged nothing for ``silent_for`` up to ``as_of``, or a later run of the batch began the table. Two aggregates that combine
    before their shuffle and, per batch and table, a look at the runs after."""
    finished = F.col("status") != "running"
    names = [f.split()[0] for f in AUDIT_SCHEMA.split(", ")]
    last = log.groupBy("batch_id", "audit_id", "run_id").agg(F.max(F.struct("event_at", finished.alias("finished"), *names)).alias("r"),
                                                             F.min("event_at").alias("begun_at"))
    heard = log.groupBy("run_id").agg(F.max("event_at").alias("heard_at"))
    later = log.groupBy(F.col("batch_id").alias("b"), F.col("audit_id").alias("a")).agg(F.max(F.struct("event_at", "run_id")).alias("newest"))
    j = last.join(heard, "run_id").join(later, (F.col("batch_id") == F.col("b")) & (F.col("audit_id") == F.col("a")))
    silent = F.col("heard_at") < F.lit(as_of - silent_for).cast("timestamp_ntz")
    overtaken = (F.col("newest.run_id") != F.col("run_id")) & (F.col("newest.event_at") >= F.col("begun_at"))
    status = F.when((F.col("r.status") == "running") & (silent | overtaken), BROKEN_OFF).otherwise(F.col("r.status"))
    return j.select("run_id", *[(status if n == "status" else F.col(f"r.{n}")).alias(n) for n in names], F.to_date("begun_at").alias("run_date"))

"""Change-event publish and apply.

Publish writes change events as JSON files (the file sink stands in for a
message bus; with the Kafka connector on the classpath the same frame goes
to ``format("kafka")``). Apply keeps the running state, the latest event per key by event time, then sequence, in Spark's streaming
state store: a grouped maximum in update mode, so the order in which events arrive, repeated events and restarts don't matter, and a
deleted key stays as a tombstone that late events meet. Each micro-batch writes the keys it changed for consumers. A read takes the
running state from the state store itself (Spark's state data source) over the first snapshot; it reads neither events nor earlier
changes. Events that cannot be read change nothing: a second stream keeps them for quarantine with their fault.

Of events of one key, time and sequence a delete wins, then the larger content.

Layout under a state path: ``base/`` (first snapshot), ``running/`` (checkpoint of the apply stream, with the state store), ``changed/epoch=n``
(keys changed by micro-batch n, with their latest rows), ``faults/`` and ``faults_checkpoint/``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("record_key", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("event_seq", T.LongType()),
])
OPERATIONS = ("I", "U", "D")
#: A line of the bus that is no event, as it stands.
LINE = "_line"
#: Columns of a state beside those of the row, in the order that decides which event is the latest.
MARKS = ("_event_ts", "_event_seq", "_deleted")
MARKS_DDL = "_event_ts timestamp_ntz, _event_seq bigint, _deleted boolean"


def publish(events: DataFrame, path: str, sequence: Column | None = None) -> None:
    """Append events to the bus. ``sequence`` orders events of one key and
    time; without it (and without an ``event_seq`` column) it is 0, and a delete wins over other events of its time."""
    if "event_seq" not in events.columns or sequence is not None:
        events = events.withColumn("event_seq", (F.lit(0) if sequence is None else sequence).cast("bigint"))
    events.write.mode("append").json(path)


def _state_schema(row_schema: T.StructType) -> T.StructType:
    marks = T._parse_datatype_string(MARKS_DDL).fields
    # files are read back nullable
    return T.StructType([T.StructField(f.name, f.dataType) for f in [*row_schema.fields, *marks]])


def init_state(snapshot: DataFrame, state_path: str) -> None:
    """A new state that holds the rows of ``snapshot``; any event is later than those."""
    base = snapshot.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(MARKS_DDL)])
    base.write.mode("errorifexists").parquet(f"{state_path}/base")


def read_events(events: DataFrame, keys, row_schema: T.StructType) -> DataFrame:
    """Events with the row that ``data`` holds, the marks, and ``_fault``: why an event cannot be applied, or NULL. The key comes from the row;
    a single-column key of an event without readable data (a delete) from ``record_key``. Data is unreadable if it is no JSON object or any
    field of it does not have its type; only a delete whose key is known from ``record_key`` needs no data."""
    keys = list(keys)
    corrupt = "_unreadable"
    schema = T.StructType([*row_schema.fields, T.StructField(corrupt, T.StringType())])
    row = F.from_json("data", schema, {"columnNameOfCorruptRecord": corrupt})
    # JSON parsed once: a struct column the others are taken from
    e = events.withColumn("_row", row)
    ok = F.col("_row").isNotNull() & F.col(f"_row.{corrupt}").isNull()
    field = lambda f: F.when(ok, F.col(f"_row.{f.name}"))
    delete = F.col("operation").eqNullSafe(F.lit("D"))
    values = {f.name: field(f) if [f.name] != keys else F.coalesce(field(f), F.when(delete, F.col("record_key").try_cast(f.dataType))) for f in row_schema.fields}
    whole = reduce(lambda a, b: a & b, [values[k].isNotNull() for k in keys])
    fault = (F.when(~F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False)), "unknown_operation").when(F.col("event_ts").isNull(), "no_time")
             .when(~ok & F.col("data").isNotNull() & ~(delete & whole), "unreadable_data").when(F.col("data").isNull() & ~delete, "no_data")
             .when(~whole, "no_key"))
    return e.select(*events.columns, *[v.alias(f"_v_{name}") for name, v in values.items()], fault.alias("_fault"))


def log_rows(events: DataFrame, keys, row_schema: T.StructType) -> DataFrame:
    """The events that can be applied, as rows with their marks."""
    read = read_events(events, keys, row_schema).filter("_fault IS NULL")
    return read.select(*[F.col(f"_v_{f.name}").alias(f.name) for f in row_schema.fields], F.col("event_ts").alias("_event_ts"),
                       F.coalesce("event_seq", F.lit(0)).alias("_event_seq"), (F.col("operation") == "D").alias("_deleted"))


def faults(events: DataFrame, keys, row_schema: T.StructType) -> DataFrame:
    """The events that cannot be applied, as they came, with ``fault``."""
    return read_events(events, keys, row_schema).filter("_fault IS NOT NULL").select(*events.columns, F.col("_fault").alias("fault"))


def latest(rows: DataFrame, keys) -> DataFrame:
    """The latest row per key, tombstones included. The grouped
    maximum combines before the shuffle, so a key with a third of all events
    is one row per map task. Rows without a whole key are left out."""
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys and c not in MARKS]
    g = rows.dropna(subset=keys).groupBy(*keys).agg(F.max(F.struct(*MARKS, *rest)).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [*MARKS, *rest]]).select(*rows.columns)


def running(spark: SparkSession, state_path: str, keys, row_schema: T.StructType) -> DataFrame:
    """The rows of the state store after the last finished micro-batch, one per key that any event named; none before the first."""
    schema = _state_schema(row_schema)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    commits = hadoop.Path(f"{state_path}/running/commits")
    fs = commits.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(commits) or not [s for s in fs.listStatus(commits) if s.getPath().getName().isdigit()]:
        return spark.createDataFrame([], schema)
    stored = spark.read.format("statestore").load(f"{state_path}/running")
    held = F.col("value").getField(stored.schema["value"].dataType.names[0])   # the one aggregate's buffer
    return stored.select(*[(F.col(f"key.{f.name}") if f.name in keys else held.getField(f.name)).alias(f.name) for f in schema.fields])


def states(spark: SparkSession, state_path: str, keys, row_schema: T.StructType) -> DataFrame:
    """The latest row per key of first snapshot and running state (at most two rows a key), tombstones included."""
    base = spark.read.schema(_state_schema(row_schema)).parquet(f"{state_path}/base")
    return latest(base.unionByName(running(spark, state_path, keys, row_schema)), keys)


def current(spark: SparkSession, state_path: str, keys, row_schema: T.StructType) -> DataFrame:
    """The rows of the state, deleted keys left out."""
    return states(spark, state_path, keys, row_schema).filter(~F.coalesce("_deleted", F.lit(False))).select(*row_schema.fieldNames())


def unkeyed(spark: SparkSession, state_path: str, keys, row_schema: T.StructType) -> DataFrame:
    """Rows of the first snapshot without a whole key, for quarantine; events without one are among the ``faults``."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return spark.read.schema(_state_schema(row_schema)).parquet(f"{state_path}/base").filter(~whole)


def compact(spark: SparkSession, state_path: str, new_path: str, keys, row_schema: T.StructType) -> None:
    """Writes the latest row per key, tombstones with their times included, as
    the first snapshot of a new state whose state store is empty. Run it when no apply stream writes to ``state_path``, and start
    the next one on ``new_path``: events that it reads again change nothing."""
    states(spark, state_path, keys, row_schema).write.mode("errorifexists").parquet(f"{new_path}/base")


def _events(spark: SparkSession, events_path: str, max_files: int | None) -> DataFrame:
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(LINE, T.StringType())])
    reader = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", LINE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(events_path)


def _started(writer, available_now: bool):
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def start_apply_stream(spark: SparkSession, events_path: str, state_path: str, keys, row_schema: T.StructType, available_now: bool = True,
                       max_files: int | None = 1000):
    """Stream change events into the running state. Events of a micro-batch combine per key before the shuffle; the state store holds one row per
    key. The keys a micro-batch changed go to ``changed/epoch=n``; a replayed micro-batch replaces its own."""
    keys = list(keys)
    rows = log_rows(_events(spark, events_path, max_files), keys, row_schema)
    rest = [f.name for f in row_schema.fields if f.name not in keys]
    state = rows.groupBy(*keys).agg(F.max(F.struct(*MARKS, *rest)).alias("_r"))

    def write_changed(batch: DataFrame, epoch: int):
        out = batch.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in (*rest, *MARKS)])
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{state_path}/changed/epoch={int(epoch)}")

    return _started(state.writeStream.outputMode("update").foreachBatch(write_changed)
                    .option("checkpointLocation", f"{state_path}/running"), available_now)


def start_fault_stream(spark: SparkSession, events_path: str, state_path: str, keys, row_schema: T.StructType, available_now: bool = True,
                       max_files: int | None = 1000):
    """Stream the events that cannot be applied to ``faults/``, through the file sink, which commits a micro-batch once."""
    bad = faults(_events(spark, events_path, max_files), list(keys), row_schema)
    return _started(bad.writeStream.format("parquet").outputMode("append").option("path", f"{state_path}/faults")
                    .option("checkpointLocation", f"{state_path}/faults_checkpoint"), available_now)


def stored_faults(spark: SparkSession, state_path: str) -> DataFrame:
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(LINE, T.StringType()), T.StructField("fault", T.StringType())])
    return spark.read.schema(schema).parquet(f"{state_path}/faults")

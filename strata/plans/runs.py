"""Ingest jobs and run audits.

Tables are driver-side specs; each table is one Spark job whose executors
read the source in parallel (parquet splits or JDBC partitions). Several
tables can run concurrently from a thread pool, each in its own FAIR
scheduler pool. Per-table row counts come from write-time observations;
the run audit is a metadata-sized DataFrame.
"""

from __future__ import annotations

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .. import contracts as C
from ..operators import bronze as B, catalog as CAT
from ..sources import sinks
from ..sources.tables import local_frame, parse_qualified, scan_table
from .run_log import AUDIT_SCHEMA, STATUSES, RunLog

def _utcnow() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class TableSpec:
    source_table: str
    source_schema: str = "dbo"
    target_table: str | None = None
    target_schema: str = "bronze"
    naming: str = "{schema}_{table}"

    @classmethod
    def parse(cls, name: str, default_schema: str = "dbo", **kw) -> "TableSpec":
        schema, table = parse_qualified(name, default_schema)
        return cls(table, schema, **kw)

    def target(self) -> str:
        return self.target_table or B.target_name(self.naming, schema=self.source_schema, table=self.source_table)


@dataclass
class RunAudit:
    source_system: str
    batch_id: str
    started: dt.datetime = field(default_factory=_utcnow)
    entries: list = field(default_factory=list)
    log: RunLog | None = None            # events are stored there as they happen
    clock: Callable[[], dt.datetime] = _utcnow

    def _entry(self, spec: TableSpec, started, ended, rows, status, error=None) -> tuple:
        if status not in STATUSES:
            raise ValueError(f"status must be one of {STATUSES}")
        return (f"{self.batch_id}:{spec.source_schema}.{spec.source_table}", self.source_system, spec.source_schema, spec.source_table,
                f"{spec.target_schema}.{spec.target()}", started, ended, (ended - started).total_seconds() if ended else None, rows, status, error, self.batch_id)

    def begin(self, spec: TableSpec) -> dt.datetime:
        started = self.clock()
        if self.log:
            self.log.append([self._entry(spec, started, None, None, "running")], started)
        return started

    def add(self, spec: TableSpec, started, ended, rows, status, error=None):
        entry = self._entry(spec, started, ended, rows, status, error)
        self.entries.append(entry)
        if self.log:
            self.log.append([entry], ended)

    def total_rows(self) -> int:
        return sum(e[8] or 0 for e in self.entries if e[9] == "success")

    def success(self) -> bool:
        return all(e[9] in ("success", "empty") for e in self.entries)

    def frame(self, spark: SparkSession) -> DataFrame:
        return local_frame(spark, self.entries, AUDIT_SCHEMA)


def ingest_table(reader: Callable[[TableSpec], DataFrame], spec: TableSpec, lake: str, load_ts,
                 audit: RunAudit, mode: str = "replace") -> int:
    """Read -> SQL-Server bronze audit columns -> write (replace by default).
    An empty source is recorded as 'empty' with 0 rows; a failure is
    recorded and re-raised."""
    started = audit.begin(spec)
    try:
        df = reader(spec)
        if df.isEmpty():
            audit.add(spec, started, audit.clock(), 0, "empty")
            return 0
        audited = B.audit_sqlserver(df, spec.source_schema, spec.source_table, load_ts)
        rows = sinks.write_table(audited, f"{lake}/{spec.target_schema}/{spec.target()}", mode)
        audit.add(spec, started, audit.clock(), rows, "success")
        return rows
    except Exception as e:  # noqa: BLE001 - recorded, then re-raised
        audit.add(spec, started, audit.clock(), None, "failed", str(e))
        raise


def ingest_many(spark: SparkSession, reader, specs, lake: str, load_ts, audit: RunAudit,
                continue_on_error: bool = True, max_workers: int = 1) -> RunAudit:
    """Ingest several tables; with ``max_workers`` > 1 they run
    concurrently, each thread in its own FAIR scheduler pool."""
    def one(spec):
        before = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"ingest_{spec.source_table}")
        try:
            ingest_table(reader, spec, lake, load_ts, audit)
        except Exception:
            if not continue_on_error:
                raise
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", before)

    if max_workers <= 1:
        for s in specs:
            one(s)
    else:
        with ThreadPoolExecutor(max_workers=max_workers) as pool:
            for fut in [pool.submit(one, s) for s in specs]:
                fut.result()
    return audit


def ingest_all(spark: SparkSession, sf_dir: str, reader, lake: str, load_ts, audit: RunAudit,
               pattern: str | None = None, include: str | None = None, exclude: str | None = None,
               schema: str = "dbo", dry_run: bool = False):
    """Discover tables, apply include/exclude, ingest the rest. A dry run
    returns the selected names without writing (exclude is honoured)."""
    names = CAT.include_exclude(CAT.filter_names(CAT.list_tables(spark, sf_dir), pattern), include, exclude)
    selected = sorted(r.table_name for r in names.select("table_name").collect())  # one row per table
    if dry_run:
        return selected
    return ingest_many(spark, reader, [TableSpec(t, schema) for t in selected], lake, load_ts, audit)


def jdbc_reader(spark: SparkSession, url: str, properties: dict | None = None, partitioning: dict | None = None,
                fetch_size: int = 10000):
    """Reader for ``ingest_*`` from a database: ``schema.table`` per spec;
    ``partitioning`` maps a table to (column, lower, upper, partitions) for
    parallel range reads."""
    from ..sources.tables import read_jdbc

    def read(spec: TableSpec) -> DataFrame:
        part = (partitioning or {}).get(spec.source_table)
        kw = {}
        if part:
            col, lo, hi, n = part
            kw = dict(partition_column=col, lower_bound=lo, upper_bound=hi, num_partitions=n)
        return read_jdbc(spark, url, f"{spec.source_schema}.{spec.source_table}", fetch_size=fetch_size,
                         properties=properties, **kw)
    return read


def parquet_reader(spark: SparkSession, sf_dir: str):
    return lambda spec: scan_table(spark, sf_dir, spec.source_table)


def bronze_run(spark: SparkSession, sf_dir: str, lake: str, batch_id: str = C.BATCH_ID, load_ts=C.LOAD_TS,
               tables=("customer", "orders", "part"), keys=None) -> DataFrame:
    """Source -> lenient bronze for several tables; one failing table does
    not stop the others. Returns one row per table plus the success rate."""
    keys = keys or {"customer": ("c_custkey",), "orders": ("o_orderkey",), "part": ("p_partkey",)}
    rows = []
    for t in tables:
        t0 = time.time()
        try:
            src = scan_table(spark, sf_dir, t)
            br = B.audit_lenient(B.stringify(src), t, batch_id, load_ts, key_cols=keys.get(t, ()))
            n = sinks.write_batch(br, f"{lake}/staging/br_{t}", "br_batch_id", batch_id)
            rows.append((t, f"br_{t}", n, True, None, time.time() - t0))
        except Exception as e:  # noqa: BLE001
            rows.append((t, f"br_{t}", 0, False, str(e), time.time() - t0))
    df = local_frame(spark, rows, "source_table string, bronze_table string, records bigint, success boolean, "
                                     "error string, seconds double")
    ok = sum(1 for r in rows if r[3])
    return df.withColumn("run_success_rate", F.lit(ok / len(rows) * 100 if rows else 0.0))


def ingest_with_dlq(spark: SparkSession, source: DataFrame, table: str, lake: str, batch_id: str = C.BATCH_ID,
                    load_ts=C.LOAD_TS, contract=None) -> DataFrame:
    """Bronze ingest with a dead-letter queue: good rows to
    ``staging/br_{table}``, failing rows to ``staging/br_ingestion_errors``,
    both partitioned by batch id (a rerun replaces the batch). The summary
    row is built from the two writes' observed counts — no extra scan."""
    from ..operators import dlq as DLQ
    chk = DLQ.checked(source, contract)
    good = sinks.write_batch(DLQ.good_rows(chk, table, batch_id, load_ts), f"{lake}/staging/br_{table}",
                             "br_batch_id", batch_id)
    bad = sinks.write_batch(DLQ.dlq_model_rows(DLQ.dlq_rows(chk, table, batch_id), load_ts),
                            f"{lake}/staging/br_ingestion_errors", "batch_id", batch_id)
    total = good + bad
    return local_frame(
        spark, [(1, total, good, bad, round(good / total * 100, 2) if total else 0.0, bad > 0)],
        "tables_processed int, records_processed bigint, records_success bigint, records_failed bigint, "
        "success_rate double, has_errors boolean")


def promote_to_silver(spark: SparkSession, bronze: DataFrame, rules, key_col: str, lake: str, silver_table: str,
                      batch_id: str = C.BATCH_ID, load_ts=C.LOAD_TS, source_table: str | None = None,
                      passthrough=(), record_cols=None) -> dict:
    """Generic bronze -> silver promotion job: clean rows to
    ``silver/{silver_table}``, failing rows to ``silver/sl_transformation_errors``.
    Empty input returns success=False, 'No records found'. Statistics come
    from the writes' observations."""
    from ..operators import silver as S
    if bronze.isEmpty():
        return {"success": False, "records": 0, "error": "No records found"}
    source_table = source_table or f"br_{silver_table.removeprefix('sl_')}"
    clean, bad, _ = S.promote(bronze, rules, key_col, batch_id, load_ts, record_cols, source_table, silver_table,
                              passthrough=passthrough)
    promoted = sinks.write_batch(clean, f"{lake}/silver/{silver_table}", "sl_batch_id", batch_id)
    quarantined = sinks.write_batch(bad, f"{lake}/silver/sl_transformation_errors", "batch_id", batch_id)
    processed = promoted + quarantined
    return {"success": True, "bronze_records": processed, "clean_records": promoted,
            "quarantined_records": quarantined, "success_rate": promoted / processed * 100, "table": silver_table}


def set_aside(snapshot: DataFrame, keys, table: str, lake: str, batch_id: str = C.BATCH_ID) -> tuple[int, DataFrame]:
    """Quarantine of a snapshot that a history job loads: its rows with a NULL
    key or with different rows for one key, which change nothing there, go to
    ``silver/key_errors/{table}``. A rerun replaces its own batch. Returns rows
    written and the stored faulty keys, for the history operators: one aggregate finds both the rows to use and
    those to set aside, and a snapshot without a fault is not looked at again."""
    from ..operators import history as H
    spark, where = snapshot.sparkSession, f"{lake}/silver/key_faults/{table}"
    n = sinks.write_batch(H.faulty_keys(snapshot, keys), where, "batch_id", batch_id)
    schema = H.faulty_keys(snapshot, keys).schema
    faulty = spark.read.schema(schema).parquet(sinks.batch_path(where, "batch_id", batch_id)) if n else local_frame(spark, [], schema)
    bad = H.unusable(snapshot, keys, faulty) if n else snapshot.limit(0).withColumn("key_fault", F.lit(""))
    return sinks.write_batch(bad, f"{lake}/silver/key_errors/{table}", "batch_id", batch_id), faulty


WATERMARK_DDL = "watermark string, rows bigint, load_id string"


def stored_watermark(spark: SparkSession, state_path: str, before: str | None = None):
    """The newest stored watermark (text), optionally of loads before load id
    ``before``; None before the first load. One small row per load, so this
    never scans the loaded data."""
    try:
        w = spark.read.schema(WATERMARK_DDL).parquet(state_path)
        if before is not None:
            w = w.filter(F.col("load_id") < F.lit(before))
        r = w.filter(F.col("watermark").isNotNull()).orderBy(F.col("load_id").desc()).select("watermark").first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":     # first load: nothing stored yet
            return None
        raise
    return r["watermark"] if r else None


def incremental_load(spark: SparkSession, source: DataFrame, col: str, target: str, state_path: str,
                     load_id: str, batch_col: str = "load_id") -> int:
    """Append the rows of ``source`` newer than the stored watermark to
    ``target`` as partition ``load_id`` and store the new watermark.

    The filter is a literal, so it reaches the scan; the new watermark is
    the max of ``col`` observed while writing the increment, so no load ever
    re-reads the target (O(increment), not O(table)). Re-running a load id
    reads the watermark stored before it and rewrites the same partition and
    state row. Load ids must sort in load order. Returns rows written."""
    wm = stored_watermark(spark, state_path, before=load_id)
    inc = source if wm is None else source.filter(F.col(col) > F.lit(wm).cast(source.schema[col].dataType))
    obs = Observation(f"wm_{load_id}")
    observed = inc.withColumn(batch_col, F.lit(load_id)) \
        .observe(obs, F.count(F.lit(1)).alias("rows"), F.max(col).cast("string").alias("wm"))
    (observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(batch_col).parquet(target))
    got = obs.get
    rows, new_wm = int(got.get("rows", 0)), got.get("wm")
    # an empty increment keeps the previous watermark
    (local_frame(spark, [(new_wm if new_wm is not None else wm, rows)], "watermark string, rows bigint")
     .withColumn("load_id", F.lit(load_id)).coalesce(1)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id")
     .parquet(state_path))
    return rows

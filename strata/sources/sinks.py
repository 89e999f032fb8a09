"""Sinks: batch-partitioned layer tables, append/replace/fail modes, JSON.

Row counts come from an ``Observation`` on the write itself, never from a
second scan.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, functions as F

# The reference's if_exists words and their Spark save modes.
MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def _observed(df: DataFrame):
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def batch_path(path: str, batch_col: str, batch_id: str) -> str:
    """Folder of one batch in a table partitioned by batch id."""
    return f"{path}/{batch_col}={quote(str(batch_id), safe=' ')}"


def write_batch(df: DataFrame, path: str, batch_col: str, batch_id: str, fmt: str = "parquet") -> int:
    """Write one batch as its own partition folder, replacing that folder
    whole: a re-run with fewer rows, or none, leaves nothing of the earlier
    run, and other batches are untouched. An empty batch still leaves its
    (typed) folder, so the next layer can read it."""
    observed, obs = _observed(df.drop(batch_col))
    (observed.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .format(fmt).save(batch_path(path, batch_col, batch_id)))
    return int(obs.get.get("rows", 0))


def write_table(df: DataFrame, path: str, if_exists: str = "append", partition_by=None,
                fmt: str = "parquet") -> int:
    """``if_exists`` in append / replace / fail; returns rows written.
    Replacing drops every earlier row, whatever the session's partition
    overwrite mode."""
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}")
    observed, obs = _observed(df)
    w = observed.write.mode(MODES[if_exists]).option("partitionOverwriteMode", "static").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)
    return int(obs.get.get("rows", 0))


#: Partition column of tables whose naming pattern holds a day.
LOAD_DATE = "load_date"


def write_target(df: DataFrame, lake: str, target, load_date: str | None = None) -> int:
    """Writes a load to its ``operators.bronze.Target``: a dated one replaces that day's partition, another one the table. Returns rows written."""
    if target.by_date != (load_date is not None):
        raise ValueError("a load day goes with a dated target, and with no other")
    if target.by_date:
        return write_batch(df, target.path(lake), LOAD_DATE, load_date)
    return write_table(df, target.path(lake), "replace")


def read_target(spark, lake: str, target, since: str | None = None, until: str | None = None) -> DataFrame:
    """The table of a target; of a dated one the days from ``since`` to ``until``, by partition pruning: other days' files are not listed as input."""
    df = spark.read.parquet(target.path(lake))
    for bound, test in ((since, ">="), (until, "<=")):
        if bound is not None:
            df = df.filter(f"{LOAD_DATE} {test} DATE '{bound}'")
    return df


def ensure_schema(spark, schema: str, location: str | None = None) -> None:
    """CREATE SCHEMA IF NOT EXISTS for catalog-backed sinks (optionally at
    an explicit storage location instead of the warehouse default)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`{loc}")


def write_catalog_table(df: DataFrame, target_table: str, target_schema: str = "bronze",
                        if_exists: str = "append", partition_by=None, schema_location: str | None = None,
                        bucket_by: tuple | None = None) -> int:
    """Catalog-backed sink: ensure the schema exists, then save as
    ``target_schema.target_table`` with the append/replace/fail mode.
    ``bucket_by=(n, cols)`` stores the table hash-bucketed and sorted by
    ``cols``, so later joins/aggregations on those keys (SCD2 history,
    registry upserts) read it co-partitioned, without a shuffle."""
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}")
    ensure_schema(df.sparkSession, target_schema, schema_location)
    observed, obs = _observed(df)
    w = observed.write.mode(MODES[if_exists]).format("parquet")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if bucket_by:
        n, cols = bucket_by
        cols = [cols] if isinstance(cols, str) else list(cols)
        w = w.bucketBy(int(n), *cols).sortBy(*cols)
    w.saveAsTable(f"`{target_schema}`.`{target_table}`")
    return int(obs.get.get("rows", 0))


def write_json(df: DataFrame, path: str) -> None:
    """Metadata-sized frames (run audits, discovered tables) as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def copy_files(spark, folder: str, prefix: str) -> int:
    """Copies every data file of a folder beside itself under ``prefix`` + name, as a sender that delivers twice would. Returns the files copied."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = hadoop.fs.Path(folder)
    fs, n = path.getFileSystem(conf), 0
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isFile() and name[0] not in "_." and not name.startswith(prefix):
            hadoop.fs.FileUtil.copy(fs, st.getPath(), fs, hadoop.fs.Path(path, prefix + name), False, conf)
            n += 1
    return n

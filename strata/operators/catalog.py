"""Discovery and metadata: table listing, column catalog, row counts,
key/relationship discovery, registry upsert.

Listings are metadata-sized DataFrames built from schemas; every row count
is a Spark aggregate (parquet answers COUNT(*) from footers), unioned into
one frame rather than one driver round-trip per table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..contracts import FOREIGN_KEYS, PRIMARY_KEYS
from ..sources.tables import local_frame, scan_table
from .quality import PAIR_COLS, is_unique, orphan_report, union_all

# Tables whose name contains one of these are system tables.
SYSTEM_PATTERNS = ("sys", "INFORMATION_SCHEMA", "tempdb", "msdb")

# ANSI/SQL names of Spark types, as catalogs report them.
_SIMPLE_SQL_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "binary": "BLOB",
}


def sql_type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.ArrayType):
        return sql_type_name(dt.elementType) + "[]"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.StructType):
        return "STRUCT(" + ", ".join(f"{f.name} {sql_type_name(f.dataType)}" for f in dt.fields) + ")"
    if isinstance(dt, T.MapType):
        return f"MAP({sql_type_name(dt.keyType)}, {sql_type_name(dt.valueType)})"
    return _SIMPLE_SQL_NAMES.get(dt.simpleString(), dt.simpleString().upper())


def list_tables(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, size_bytes) for every parquet table in ``folder``, be it
    one file or a folder of part files. One level is listed through the
    file system Spark reads with; sizes count the data files of a folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if not name.endswith(".parquet"):
            continue
        size = st.getLen()
        if st.isDirectory():
            size, files = 0, fs.listFiles(st.getPath(), True)
            while files.hasNext():
                f = files.next()
                if f.getPath().getName()[0] not in "_.":
                    size += f.getLen()
        rows.append((name.removesuffix(".parquet"), size))
    return local_frame(spark, rows, "table_name string, size_bytes bigint")


def catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables (not views) of a catalog database as a DataFrame, like a
    dictionary query on INFORMATION_SCHEMA.TABLES where type = BASE TABLE."""
    rows = [(t.name, t.database, t.tableType, bool(t.isTemporary))
            for t in spark.catalog.listTables(database) if t.tableType != "VIEW"]
    return local_frame(spark, rows, "table_name string, database string, table_type string, is_temporary boolean")


def filter_names(names: DataFrame, pattern: str | None = None, exclude_system: bool = True,
                 system_patterns=SYSTEM_PATTERNS, col: str = "table_name") -> DataFrame:
    """Regex search (case-insensitive) on the name; then drop names that
    contain a system pattern (case-sensitive substring)."""
    out = names
    if pattern:
        out = out.filter(F.col(col).rlike("(?i)" + pattern))
    if exclude_system:
        for p in system_patterns:
            out = out.filter(~F.col(col).contains(p))
    return out


def include_exclude(names: DataFrame, include: str | None = None, exclude: str | None = None,
                    col: str = "table_name") -> DataFrame:
    out = names
    if include:
        out = out.filter(F.col(col).rlike("(?i)" + include))
    if exclude:
        out = out.filter(~F.col(col).rlike("(?i)" + exclude))
    return out


def row_counts(spark: SparkSession, sf_dir: str, tables) -> DataFrame:
    """(table_name, row_count) — one union of per-table COUNT(*) aggregates."""
    parts = [scan_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in tables]
    return reduce(DataFrame.unionByName, parts)


def column_catalog(spark: SparkSession, sf_dir: str, tables, schema_name: str = "source") -> DataFrame:
    """One row per column: schema, table, ordinal, column, SQL type,
    nullability, view flag, declared primary key and foreign key target."""
    fk_target = {(fk.child, c): f"{fk.parent}.{p}" for fk in FOREIGN_KEYS
                 for c, p in zip(fk.child_cols, fk.parent_cols)}
    rows = []
    for t in tables:
        schema = scan_table(spark, sf_dir, t).schema
        for i, f in enumerate(schema.fields, start=1):
            rows.append((schema_name, t, i, f.name, sql_type_name(f.dataType), bool(f.nullable), False,
                         f.name in PRIMARY_KEYS.get(t, ()), fk_target.get((t, f.name))))
    cat_schema = ("schema_name string, table_name string, ordinal_position int, column_name string, "
                  "data_type string, is_nullable boolean, is_view boolean, is_primary_key boolean, "
                  "references_column string")
    return local_frame(spark, rows, cat_schema)


def table_metadata(spark: SparkSession, sf_dir: str, tables) -> DataFrame:
    """Columns, keys and row count per table: the column catalog joined to
    the row counts on table name (both metadata-sized)."""
    # one row count per table: bounded by the number of tables
    return column_catalog(spark, sf_dir, tables).join(F.broadcast(row_counts(spark, sf_dir, tables)), "table_name")


def discover(spark: SparkSession, sf_dir: str, pattern: str | None = None, exclude_system: bool = True) -> DataFrame:
    """Tables matching ``pattern`` with their row and column counts."""
    names = filter_names(list_tables(spark, sf_dir), pattern, exclude_system).select("table_name")
    found = [r.table_name for r in names.collect()]   # metadata-sized: one row per table
    if not found:
        return local_frame(spark, [], "table_name string, column_count int, row_count bigint")
    cols = column_catalog(spark, sf_dir, found).groupBy("table_name") \
        .agg(F.count(F.lit(1)).cast("int").alias("column_count"))
    return cols.join(row_counts(spark, sf_dir, found), "table_name")


# ---------------------------------------------------------------- key discovery
def _key_suffix(name: str) -> str:
    return name.split("_", 1)[1] if "_" in name and not name.endswith("_id") else name


def key_groups(spark: SparkSession, sf_dir: str, tables) -> list[list[tuple[str, str]]]:
    """Integer columns named like keys (*key, *_id), as (table, column), in
    groups whose names match after the table prefix."""
    keyish: dict[str, list] = {}
    for t in tables:
        for f in scan_table(spark, sf_dir, t).schema.fields:
            if isinstance(f.dataType, (T.IntegerType, T.LongType)) and (f.name.endswith("key") or f.name.endswith("_id")):
                keyish.setdefault(_key_suffix(f.name), []).append((t, f.name))
    return [g for g in keyish.values() if len({t for t, _ in g}) > 1]


def fk_candidates(spark: SparkSession, sf_dir: str, tables) -> DataFrame:
    """Candidate foreign keys: key columns whose names match a unique key
    column of another table, the child rows with a non-null value missing
    there, and the verdict. Only unique columns become parents, so many
    tables that share a key column are not all paired with each other."""
    groups = key_groups(spark, sf_dir, tables)
    frames = {t: scan_table(spark, sf_dir, t) for g in groups for t, _ in g}
    columns = [c for g in groups for c in g]
    none = local_frame(spark, [], ", ".join(f"{c} string" for c in PAIR_COLS) + ", orphan_rows bigint, parent_unique boolean, is_foreign_key boolean")
    if not columns:
        return none
    found = union_all([is_unique(frames[t], [c]).select(F.lit(t).alias("t"), F.lit(c).alias("c"), "parent_unique") for t, c in columns])
    parents = {(r.t, r.c) for r in found.filter("parent_unique").collect()}   # one row per key column
    pairs = [(ct, cc, pt, pc) for g in groups for ct, cc in g for pt, pc in g if ct != pt and (pt, pc) in parents]
    if not pairs:
        return none
    return orphan_report(frames, pairs).select(
        *PAIR_COLS, "orphan_rows", F.lit(True).alias("parent_unique"), (F.col("orphan_rows") == 0).alias("is_foreign_key"))


# ---------------------------------------------------------------- registry upsert
def registry_rows(spark: SparkSession, frames: dict, as_of, source_system: str = "parquet") -> DataFrame:
    """Registry rows (table_name, source_system, row_count, columns_json,
    schema_hash, last_ingestion_at) for named DataFrames."""
    parts = []
    for name, df in frames.items():
        cols_json = "[" + ",".join('{"name":"%s","type":"%s"}' % (f.name, sql_type_name(f.dataType))
                                   for f in df.schema.fields) + "]"
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(source_system).alias("source_system"), "row_count",
            F.lit(cols_json).alias("columns_json"),
            F.lit(as_of).cast("timestamp_ntz").alias("last_ingestion_at")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("content_hash", F.md5(F.concat_ws("|", F.col("row_count").cast("string"),
                                                            F.col("columns_json"))))


def storage(spark: SparkSession, sf_dir: str, tables) -> DataFrame:
    """(table_name, n_files, size_bytes, largest_file, newest_file) of stored tables, from Spark's hidden ``_metadata`` column: executors name the file
    that each row comes from, no data column is read, and rows of one file combine before the shuffle. Files without rows don't
    count."""
    parts = [scan_table(spark, sf_dir, t).select(F.lit(t).alias("table_name"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                                                 F.col("_metadata.file_modification_time").alias("at")) for t in tables]
    files = reduce(DataFrame.unionByName, parts).groupBy("table_name", "path").agg(F.max("size").alias("size"), F.max("at").alias("at"))
    found = files.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("size_bytes"), F.max("size").alias("largest_file"),
                                            F.max("at").alias("newest_file"))
    return found


# Names of connection settings that hold secrets.
SECRET_SETTINGS = ("pwd", "password", "secret", "token")


def masked(connection: str) -> Column:
    """A connection text with the values of its secret settings starred out."""
    return F.regexp_replace(F.lit(connection), r"(?i)\b(" + "|".join(SECRET_SETTINGS) + r")\s*=\s*[^;]*", "$1=***")


def with_storage(registry: DataFrame, stored: DataFrame, connection: Column) -> DataFrame:
    """Registry rows with the size and files of their tables (0 for tables without rows) and the masked connection text. Both sides are
    metadata-sized."""
    return registry.join(stored.select("table_name", "n_files", "size_bytes"), "table_name", "left").na.fill(0, ["n_files", "size_bytes"]).withColumn(
        "connection_text", connection)


def upsert_registry(old: DataFrame, new: DataFrame, now) -> DataFrame:
    """Full outer join on table_name: new values win; created_at is kept
    from the old row; updated_at moves only when the content hash changed."""
    now = F.lit(now).cast("timestamp_ntz")
    o = old.alias("o")
    n = new.alias("n")
    j = o.join(n, F.col("o.table_name") == F.col("n.table_name"), "full_outer")
    changed = F.col("o.content_hash").isNull() | F.col("n.content_hash").isNull() | \
        (F.col("o.content_hash") != F.col("n.content_hash"))
    pick = lambda c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c)
    return j.select(
        pick("table_name"), pick("source_system"), pick("row_count"), pick("columns_json"),
        pick("content_hash"), pick("last_ingestion_at"),
        F.coalesce(F.col("o.created_at"), now).alias("created_at"),
        F.when(F.col("n.table_name").isNull(), F.col("o.updated_at"))
         .when(changed, now).otherwise(F.col("o.updated_at")).alias("updated_at"),
    )

"""Scans: whole table, projected, custom query, parameterised query, JDBC.

All scans are lazy; column lists and filters are left to Catalyst, which
prunes them into the parquet reader (ReadSchema / PushedFilters) or into
the JDBC SELECT.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def local_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """A metadata-sized frame built on the driver (run audits, catalog rows,
    manifests, pair lists). Rows go to the JVM as one Arrow table and plan as
    a ``LocalRelation``: no Python worker runs, and the optimizer knows the
    frame's size (a list-built frame is an RDD scan of unknown size)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(st)
    rows = [tuple(r[f.name] for f in st.fields) if isinstance(r, dict) else tuple(r) for r in rows]
    cols = list(zip(*rows)) if rows else [() for _ in st.fields]
    table = pa.Table.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(cols, arrow)], schema=arrow)
    return spark.createDataFrame(table, st)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_SCHEMAS: dict = {}


def scan_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Whole table by name. Source tables are read-only inputs, so their
    schema is inferred once per application and then passed explicitly,
    which skips the footer read on every later scan."""
    path = table_path(sf_dir, name)
    key = (spark.sparkContext.applicationId, path)
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def scan_projected(spark: SparkSession, sf_dir: str, name: str, columns) -> DataFrame:
    """Fixed column list; only those columns are read from storage."""
    return scan_table(spark, sf_dir, name).select(*columns)


def scan_query(spark: SparkSession, query: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """A custom SQL query over named DataFrames: ``{orders}`` in the text is
    bound to the ``orders=`` DataFrame; ``:name`` markers are bound from
    ``args`` (values are never spliced into the SQL text)."""
    return spark.sql(query, args=args, **tables)


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, *, query: str | None = None, columns=None,
              partition_column: str | None = None, lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int = 4, fetch_size: int = 10000, properties: dict | None = None) -> DataFrame:
    """Batched, optionally partitioned JDBC read of a table or a custom query.

    With a numeric ``partition_column`` the table is read by
    ``num_partitions`` parallel range queries (one connection each, rows
    streamed ``fetch_size`` at a time); the column list becomes the SELECT
    list of each query and filters are pushed into its WHERE clause. A
    custom ``query`` runs as a subquery (Spark cannot range-partition it;
    wrap it as ``dbtable='(query) q'`` with a partition column for that).
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
    reader = reader.option("dbtable", table) if table is not None else reader.option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    df = reader.load()
    return df.select(*columns) if columns else df


def key_ranges(df: DataFrame, key: str, n: int, accuracy: int = 10000, written: str | None = None) -> list[str]:
    """At most ``n`` conditions on ``key`` that split the rows into ranges of about equal size, however the values are spread: bounds are quantiles,
    from one aggregate that combines before its shuffle. Rows without a key have a condition of their own if there are any. A single value
    is never split, so one that holds more than its share makes fewer, unequal ranges. Values are written as SQL literals, so the conditions work in
    any source that searches by key: a database's predicates (``written``: the key as its SQL spells it), or filters pushed into a scan."""
    t = df.schema[key].dataType
    if not isinstance(t, (T.IntegralType, T.DecimalType, T.DateType)):
        raise ValueError(f"{key}: ranges need whole numbers, decimals or days")
    got = df.agg(F.percentile_approx(key, [k / n for k in range(1, n)], accuracy).cast("array<string>").alias("q") if n > 1 else F.array().cast("array<string>").alias("q"),
                 F.min(key).cast("string").alias("least"), F.count_if(F.col(key).isNull()).alias("nulls")).first()
    bounds = list(dict.fromkeys(b for b in got.q or () if b != got.least))
    literal = (lambda v: f"DATE '{v}'") if isinstance(t, T.DateType) else str
    edges, k = [None, *map(literal, bounds), None], written or key
    out = [" AND ".join(x for x in (lo and f"{k} >= {lo}", hi and f"{k} < {hi}") if x) or f"{k} IS NOT NULL" for lo, hi in zip(edges, edges[1:])]
    return out + ([f"{k} IS NULL"] if got.nulls else [])


def scan_ranges(df: DataFrame, key: str, n: int, columns) -> DataFrame:
    """A projected read of a table as ``n`` reads of ranges of its key, each with its condition pushed into its scan. For stored tables that are sorted by
    the key or have an index on it: each range reads its own part only."""
    parts = [df.filter(condition).select(*columns) for condition in key_ranges(df, key, n)]
    return reduce(DataFrame.unionByName, parts)


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, key: str, n: int, *, columns=None, fetch_size: int = 10000, properties: dict | None = None) -> DataFrame:
    """A database table read by ``n`` queries side by side, over ranges of ``key`` with about as many rows each. The quantiles cost one more read of the
    key column."""
    keys = read_jdbc(spark, url, query=f"SELECT {key} FROM {table}", fetch_size=fetch_size, properties=properties)
    df = spark.read.jdbc(url, table, predicates=key_ranges(keys, keys.columns[0], n, written=key), properties={"fetchsize": str(fetch_size), **(properties or {})})
    return df.select(*columns) if columns else df


def parse_qualified(name: str, default_schema: str = "dbo") -> tuple[str, str]:
    """'schema.table' -> (schema, table); a bare name gets the default schema."""
    if "." in name:
        schema, tbl = name.split(".", 1)
        return schema, tbl
    return default_schema, name

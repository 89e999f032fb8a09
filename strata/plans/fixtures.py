"""Inputs derived from the driver tables.

The driver tables are clean, so the bronze/silver flow runs over a view of
``customer`` that injects every defect class the validators handle. All
rows of the table are kept; the key arithmetic only decides which defect a
row carries. The same SQL text runs in Spark (``{customer}`` is bound to a
DataFrame) and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import scan_table

DIRTY_CUSTOMER_SQL = """
SELECT
 CASE WHEN c_custkey % 97 = 1 THEN NULL WHEN c_custkey % 89 = 1 THEN concat('X', CAST(c_custkey AS STRING))
      ELSE CAST(c_custkey AS STRING) END AS customer_id,
 CASE WHEN c_custkey % 83 = 2 THEN '1.0' ELSE CAST(c_nationkey % 2 + 1 AS STRING) END AS store_id,
 CASE WHEN c_custkey % 79 = 3 THEN repeat('N', 101) WHEN c_custkey % 73 = 3 THEN ''
      ELSE concat('  ', c_mktsegment, ' ') END AS first_name,
 CASE WHEN c_custkey % 71 = 4 THEN NULL ELSE c_name END AS last_name,
 CASE WHEN c_custkey % 67 = 5 THEN NULL WHEN c_custkey % 61 = 5 THEN 'no-at-sign' WHEN c_custkey % 59 = 5 THEN 'a@b@c.com'
      WHEN c_custkey % 5 = 0 THEN concat('User', CAST(c_custkey AS STRING), '@GMAIL.com')
      WHEN c_custkey % 5 = 1 THEN concat('u', CAST(c_custkey AS STRING), '@uni.edu')
      ELSE concat('u', CAST(c_custkey AS STRING), '@example.com') END AS email,
 CASE WHEN c_custkey % 53 = 6 THEN 'abc' WHEN c_custkey % 7 = 0 THEN NULL
      ELSE CAST(c_nationkey + 1 AS STRING) END AS address_id,
 CASE WHEN c_custkey % 47 = 7 THEN 'maybe' WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN 'f'
      ELSE 'True' END AS activebool,
 CASE WHEN c_custkey % 43 = 8 THEN '2022-02-30' WHEN c_custkey % 41 = 8 THEN '2022'
      ELSE '2022-02-14' END AS create_date,
 CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE '2022-02-15T09:57:20Z' END AS last_update,
 CASE WHEN c_custkey % 37 = 9 THEN '2' WHEN c_custkey % 31 = 9 THEN 'one' WHEN c_custkey % 8 = 0 THEN NULL
      WHEN c_custkey % 8 = 1 THEN '0' ELSE '1' END AS active
FROM {customer}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, sf_dir, name)


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped text rows (10 customer fields) with injected defects."""
    return spark.sql(DIRTY_CUSTOMER_SQL, customer=table(spark, sf_dir, "customer"))


def dirty_rows(customers: DataFrame, carry: str) -> DataFrame:
    """The same view of given customer rows, with one more column of theirs."""
    sql = DIRTY_CUSTOMER_SQL.replace("\nFROM {customer}", f", {carry}\nFROM {{customer}}")
    return customers.sparkSession.sql(sql, customer=customers)


# Two snapshots of a keyed table, for history operators. Snapshot 1 is the
# state at the first load: keys with k % 10 = 9 had not arrived yet.
# Snapshot 2 is the next full extract: keys with k % 10 = 7 were deleted at
# the source and keys with k % 10 = 3 changed one attribute.
def customer_snapshot_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.filter(F.col("c_custkey") % 10 != 9)


def customer_snapshot_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return (c.filter(F.col("c_custkey") % 10 != 7)
            .withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 3,
                                            F.round(F.col("c_acctbal") + F.lit(100.0), 2))
                        .otherwise(F.col("c_acctbal"))))


# Four loads of one table in the order they arrive: (load time, batch, rows).
# The third arrives after the second but is older, the fourth is older still.
# (not in the load; a changed balance), as tests of the key's last digit.
LOADS = (
    ("2024-01-01 00:00:00", "load_a", "k % 10 = 9", "k % 10 = 1"),
    ("2024-03-01 00:00:00", "load_c", "k % 10 = 7", "k % 10 IN (1, 3)"),
    ("2024-02-01 00:00:00", "load_b", "k % 10 IN (5, 7)", "k % 10 IN (3, 4, 6)"),
    ("2023-12-01 00:00:00", "load_0", "k % 10 IN (2, 9)", "k % 10 = 8"),
)


def customer_loads(spark: SparkSession, sf_dir: str):
    """The loads as (load time, batch id, snapshot): rows that are there later or no more are missing, some balances differ."""
    c = table(spark, sf_dir, "customer")
    for t, batch, missing, changed in LOADS:
        missing, changed = (x.replace("k %", "c_custkey %") for x in (missing, changed))
        yield t, batch, c.filter(f"NOT ({missing})").withColumn(
            "c_acctbal", F.expr(f"CASE WHEN {changed} THEN round(c_acctbal + 100.0, 2) ELSE c_acctbal END"))


def part_snapshot_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.filter(F.col("p_partkey") % 10 != 7)


# Events that cannot be applied: what is wrong with the event of a key, by the key's last digits.
UNREADABLE_EVENTS_SQL = """
SELECT 'customer' AS table_name, CASE WHEN c_custkey % 30 = 20 THEN 'X' ELSE 'U' END AS operation, CAST(c_custkey AS STRING) AS record_key,
 CASE WHEN c_custkey % 30 = 0 THEN 'not json'
      WHEN c_custkey % 30 = 10 THEN concat('{{"c_custkey":', CAST(c_custkey AS STRING), ',"c_acctbal":"abc"}}')
      WHEN c_custkey % 30 = 5 THEN NULL WHEN c_custkey % 30 = 15 THEN '{{"c_name":"nobody"}}'
      ELSE concat('{{"c_custkey":', CAST(c_custkey AS STRING), '}}') END AS data
FROM {customer} WHERE c_custkey % 5 = 0 AND c_custkey % 30 <> 25
"""


def unreadable_events(spark: SparkSession, sf_dir: str, at: str) -> DataFrame:
    sql = UNREADABLE_EVENTS_SQL
    return spark.sql(sql, customer=table(spark, sf_dir, "customer")).withColumn("event_ts", F.lit(at).cast("timestamp_ntz"))


# What rules over a whole batch look at: customers that come twice, customers stored by an earlier batch, and the parents of ``address_id``, of
# which one is missing and some are held twice.
CUSTOMER_BATCH_SQL = DIRTY_CUSTOMER_SQL + " UNION ALL " + DIRTY_CUSTOMER_SQL + " WHERE c_custkey % 13 = 0"
STORED_CUSTOMERS_SQL = "SELECT CAST(c_custkey AS STRING) AS customer_id FROM {customer} WHERE c_custkey % 17 = 0"
ADDRESS_PARENTS_SQL = ("SELECT n_nationkey AS address_id FROM {nation} "
                       "UNION ALL SELECT n_nationkey FROM {nation} WHERE n_regionkey = 2")


def customer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CUSTOMER_BATCH_SQL, customer=table(spark, sf_dir, "customer"))


def stored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(STORED_CUSTOMERS_SQL, customer=table(spark, sf_dir, "customer"))


def address_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ADDRESS_PARENTS_SQL, nation=table(spark, sf_dir, "nation"))

"""JDBC round trip against embedded in-memory Derby (no server, no port)."""

from pyspark.sql import functions as F

from strata.sources.tables import read_jdbc

from .conftest import SF001

URL = "jdbc:derby:memory:strata_test;create=true"


def test_jdbc_partitioned_read_roundtrip(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                                   "o_totalprice")
    (orders.write.format("jdbc").option("url", URL).option("dbtable", "ORDERS")
     .option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").mode("overwrite").save())
    back = read_jdbc(spark, URL, "ORDERS", columns=["O_ORDERKEY", "O_TOTALPRICE"], partition_column="O_ORDERKEY",
                     lower_bound=0, upper_bound=1500, num_partitions=3, fetch_size=500,
                     properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert back.rdd.getNumPartitions() == 3
    assert back.count() == orders.count()
    assert round(back.agg(F.sum("O_TOTALPRICE")).first()[0], 2) == round(orders.agg(F.sum("o_totalprice")).first()[0], 2)
    pushed = back.filter(F.col("O_ORDERKEY") < 10)
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and pushed.count() == 10


DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_custom_query_and_ingest(spark, tmp_path):
    from strata.plans import runs as RUN
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    (nation.write.format("jdbc").option("url", URL).option("dbtable", "NATION").options(**DRIVER)
     .mode("overwrite").save())
    # Spark created the columns quoted (lower case), so raw SQL quotes them too
    q = read_jdbc(spark, URL, query='SELECT "n_nationkey", "n_name" FROM NATION WHERE "n_regionkey" = 1',
                  properties=DRIVER)
    assert q.count() == nation.filter(F.col("n_regionkey") == 1).count()
    audit = RUN.RunAudit("derby", "b1")
    reader = RUN.jdbc_reader(spark, URL, DRIVER, partitioning={"NATION": ("n_nationkey", 0, 25, 2)})
    n = RUN.ingest_table(reader, RUN.TableSpec.parse("APP.NATION"), str(tmp_path), "2024-01-01 00:00:00", audit)
    assert n == 25 and audit.entries[0][9] == "success"
    back = spark.read.parquet(f"{tmp_path}/bronze/APP_NATION")
    assert back.filter(F.col("_bronze_source_schema") == "APP").count() == 25


def test_ranges_of_a_skewed_key_are_even_and_pushed_down(spark):
    from strata.sources.tables import key_ranges, read_jdbc_ranges, scan_ranges
    # nine tenths of the keys in a thousandth of their span, some rows without one, one value with a tenth of all rows
    rows = [(k if k < 900 else 1000 * (k - 899) if k < 1000 else None if k < 1010 else 500, k) for k in range(1110)]
    df = spark.createDataFrame(rows, "k long, v long")
    conditions = key_ranges(df, "k", 8)
    sizes = [df.filter(c).count() for c in conditions]
    assert sum(sizes) == len(rows) and conditions[-1] == "k IS NULL" and sizes[-1] == 10
    assert len(conditions) == 9 and max(sizes[:-1]) <= 2 * len(rows) / 8
    equal = [max(1, df.filter(f"k >= {lo} AND k < {lo + 12500}").count()) for lo in range(0, 100_000, 12500)]
    assert max(equal) > 4 * max(sizes[:-1])   # ranges of equal width would put nearly all into one
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    read = scan_ranges(orders, "o_orderkey", 4, ["o_orderkey", "o_totalprice"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(o_orderkey") == 3 and plan.count("LessThan(o_orderkey") == 3 and "o_orderpriority" not in plan
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, orders.select("o_orderkey", "o_totalprice").collect()))
    assert key_ranges(orders.limit(0), "o_orderkey", 4) == ["o_orderkey IS NOT NULL"]
    df.write.format("jdbc").option("url", URL).option("dbtable", "SKEWED").options(**DRIVER).mode("overwrite").save()
    back = read_jdbc_ranges(spark, URL, "SKEWED", '"k"', 8, properties=DRIVER)
    counts = [len(p) for p in back.rdd.glom().collect()]
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows)) and len(counts) == 9 and max(counts) <= 2 * len(rows) / 8

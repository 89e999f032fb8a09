"""Golden counts of the calendar and gold rules."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import gold as G


def test_dim_date_golden_counts(spark):
    d = G.dim_date(G.fixed_span(spark, "2005-01-01", "2025-12-31"), "b", "2024-01-01 00:00:00")
    r = d.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_month_end").alias("me"),
              F.count_if("is_quarter_end").alias("qe"), F.count_if("is_year_end").alias("ye")).first()
    assert (r.n, r.me, r.qe, r.ye) == (7670, 252, 84, 21)
    legacy = G.dim_date(G.fixed_span(spark, "2005-01-01", "2025-12-31"), "b", "2024-01-01 00:00:00", compat=True)
    r = legacy.agg(F.count_if("is_month_end").alias("me"), F.count_if("is_quarter_end").alias("qe")).first()
    assert (r.me, r.qe) == (7670, 2562)


def test_dim_date_matches_python_calendar(spark):
    d = G.dim_date(G.fixed_span(spark, "2005-01-01", "2025-12-31"), "b", "2024-01-01 00:00:00")
    rows = d.select("full_date", "date_key", "quarter", "month_name", "month_abbr", "day_of_week", "day_name",
                    "day_abbr", "day_of_year", "week_of_year", "is_weekend", "season").collect()
    seasons = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
               6: "Summer", 7: "Summer", 8: "Summer"}
    for r in rows:
        x: dt.date = r.full_date
        assert r.date_key == int(x.strftime("%Y%m%d"))
        assert r.quarter == (x.month - 1) // 3 + 1
        assert (r.month_name, r.month_abbr, r.day_name, r.day_abbr) == \
            (x.strftime("%B"), x.strftime("%b"), x.strftime("%A"), x.strftime("%a"))
        assert r.day_of_week == x.weekday() + 1
        assert r.day_of_year == x.timetuple().tm_yday
        assert r.week_of_year == x.isocalendar()[1]
        assert r.is_weekend == (x.weekday() >= 5)
        assert r.season == seasons.get(x.month, "Fall")


def test_segment_rules(spark):
    df = spark.createDataFrame([
        ("a@GMAIL.com", "A", "B"), ("a@uni.edu", "A", "B"), ("a@x.com", "Abcdefghijk", "Abcdefghijk"),
        ("a@x.com", "A", "B"), (None, "A", "B")], "email string, first_name string, last_name string")
    out = [r[0] for r in df.select(G.customer_segment()).collect()]
    assert out == ["Standard", "Premium", "Premium", "Basic", "Basic"]
    dom = [r[0] for r in df.select(G.email_domain()).collect()]
    assert dom == ["GMAIL.com", "uni.edu", "x.com", "x.com", "unknown"]
    b = [r[0] for r in df.select(G.name_length_bucket()).collect()]
    assert b == ["Short", "Short", "Long", "Short", "Short"]



def test_is_active_needs_both_flags_and_is_never_null(spark):
    # Python's `bool(activebool) and active == 1`: a missing value is not active
    df = spark.createDataFrame(
        [(1, True, 1), (2, True, 0), (3, False, 1), (4, None, 1), (5, True, None), (6, None, None)],
        "customer_id int, activebool boolean, active int") \
        .selectExpr("customer_id", "activebool", "active", "'k' AS sl_customer_key", "'A' AS first_name",
                    "'B' AS last_name", "'a@x.com' AS email", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS sl_load_time")
    out = {r.customer_id: r.is_active for r in G.dim_customer(df, "b", "2024-01-01 00:00:00").collect()}
    assert out == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False}

# Mock warehouse customers (10 literal rows of the reference's sample table).
MOCK_CUSTOMERS = [
    (1, "John", "Doe", "john.doe@example.com", "555-0101", "123 Main St", "Seattle", "WA", "98101", "USA"),
    (2, "Jane", "Smith", "jane.smith@example.com", "555-0102", "456 Oak Ave", "Portland", "OR", "97201", "USA"),
    (3, "Bob", "Johnson", "bob.johnson@example.com", "555-0103", "789 Pine Rd", "San Francisco", "CA", "94102", "USA"),
    (4, "Alice", "Williams", "alice.w@example.com", "555-0104", "321 Elm St", "Los Angeles", "CA", "90001", "USA"),
    (5, "Charlie", "Brown", "charlie.b@example.com", "555-0105", "654 Maple Dr", "Denver", "CO", "80201", "USA"),
    (6, "Diana", "Davis", "diana.d@example.com", "555-0106", "987 Cedar Ln", "Phoenix", "AZ", "85001", "USA"),
    (7, "Edward", "Miller", "edward.m@example.com", "555-0107", "147 Spruce Way", "Austin", "TX", "73301", "USA"),
    (8, "Fiona", "Wilson", "fiona.w@example.com", "555-0108", "258 Birch Blvd", "Miami", "FL", "33101", "USA"),
    (9, "George", "Moore", "george.m@example.com", "555-0109", "369 Willow Ct", "Chicago", "IL", "60601", "USA"),
    (10, "Helen", "Taylor", "helen.t@example.com", "555-0110", "741 Aspen Pl", "Boston", "MA", "02101", "USA"),
]


def test_mock_customer_ingest_and_summary(spark, tmp_path):
    from strata.plans import runs as RUN
    schema = ("customer_id int, first_name string, last_name string, email string, phone string, address string, "
              "city string, state string, zip_code string, country string")
    df = spark.createDataFrame(MOCK_CUSTOMERS, schema).withColumns({
        "created_date": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
        "last_modified": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
        "is_active": F.lit(True)})
    audit = RUN.RunAudit("sqlserver", "b1")
    n = RUN.ingest_table(lambda spec: df, RUN.TableSpec.parse("dbo.Customer"), str(tmp_path), "2024-01-01 00:00:00",
                         audit)
    assert n == 10 and audit.entries[0][9] == "success"
    back = spark.read.parquet(f"{tmp_path}/bronze/dbo_Customer")
    s = back.agg(F.count(F.lit(1)).alias("total"), F.sum(F.when(F.col("is_active"), 1).otherwise(0)).alias("active")).first()
    assert (s.total, s.active) == (10, 10)
    assert set(back.columns) >= {"_bronze_loaded_at", "_bronze_source_system", "_bronze_source_schema",
                                 "_bronze_source_table"}

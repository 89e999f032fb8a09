"""Gold: customer dimension, date dimension, KPI summaries, run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Segmentation rules, first match wins.
CONSUMER_DOMAINS = ("gmail.com", "yahoo.com", "hotmail.com")
INSTITUTION_MARKERS = (".edu", ".gov", ".org")
LONG_NAME = 20
# Name-length buckets: <=10 Short, <=20 Medium, else Long.
SHORT_NAME, MEDIUM_NAME = 10, 20
# Seasons by month.
SEASONS = (((12, 1, 2), "Winter"), ((3, 4, 5), "Spring"), ((6, 7, 8), "Summer"))
OTHER_SEASON = "Fall"


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp_ntz")


def _any_contains(c: Column, needles) -> Column:
    out = None
    for n in needles:
        t = c.contains(n)
        out = t if out is None else (out | t)
    return out


def _name_len(first="first_name", last="last_name") -> Column:
    return F.length(F.coalesce(F.col(first), F.lit(""))) + F.length(F.coalesce(F.col(last), F.lit("")))


def customer_segment(email="email", first="first_name", last="last_name") -> Column:
    e = F.lower(F.coalesce(F.col(email), F.lit("")))
    return (F.when(_any_contains(e, CONSUMER_DOMAINS), "Standard")
            .when(_any_contains(e, INSTITUTION_MARKERS), "Premium")
            .when(_name_len(first, last) > LONG_NAME, "Premium")
            .otherwise("Basic"))


def email_domain(email="email") -> Column:
    e = F.col(email)
    return F.when(e.contains("@"), F.split_part(e, F.lit("@"), F.lit(2))).otherwise(F.lit("unknown"))


def name_length_bucket(first="first_name", last="last_name") -> Column:
    n = _name_len(first, last)
    return F.when(n <= SHORT_NAME, "Short").when(n <= MEDIUM_NAME, "Medium").otherwise("Long")


def dim_customer(silver: DataFrame, batch_id: str, created_at) -> DataFrame:
    """One dimension row per silver customer (a narrow projection)."""
    return silver.select(
        F.col("sl_customer_key").alias("dim_customer_key"),
        "customer_id", "first_name", "last_name",
        F.concat_ws(" ", F.coalesce("first_name", F.lit("None")), F.coalesce("last_name", F.lit("None")))
        .alias("full_name"),
        "email",
        # a missing flag counts as not active (never NULL)
        (F.coalesce(F.col("activebool"), F.lit(False)) & F.coalesce(F.col("active") == 1, F.lit(False)))
        .alias("is_active"),
        customer_segment().alias("customer_segment"),
        email_domain().alias("email_domain"),
        name_length_bucket().alias("name_length_category"),
        F.col("sl_load_time").alias("effective_date"),
        F.lit(True).alias("is_current"),
        F.lit(batch_id).alias("batch_id"),
        _ts(created_at).alias("created_at"),
    )


def date_span(df: DataFrame, col: str) -> DataFrame:
    """One row (start, end): Jan 1 of the first year to Dec 31 of the last
    year seen in ``col`` — the calendar a fact table needs."""
    return df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).select(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("end_date"),
    )


def dim_date(span: DataFrame, batch_id: str, created_at, compat: bool = False) -> DataFrame:
    """Calendar rows from a one-row (start_date, end_date) frame.

    ``compat=True`` reproduces the legacy month-end test
    (day of (28th + 4 days) <= 4), which is true on every date.
    """
    d = F.col("full_date")
    days = span.select(F.explode(F.sequence("start_date", "end_date")).alias("full_date"))
    if compat:
        month_end = legacy_month_end(d)
    else:
        month_end = d == F.last_day(d)
    season = F.lit(OTHER_SEASON)
    for months, name in reversed(SEASONS):
        season = F.when(F.month(d).isin(*months), name).otherwise(season)
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbr"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_abbr"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        month_end.alias("is_month_end"),
        (F.month(d).isin(3, 6, 9, 12) & month_end).alias("is_quarter_end"),
        ((F.month(d) == 12) & (F.dayofmonth(d) == 31)).alias("is_year_end"),
        season.alias("season"),
        F.lit(batch_id).alias("batch_id"),
        _ts(created_at).alias("created_at"),
    )


def legacy_month_end(d: Column) -> Column:
    """The legacy test: day of (the 28th of d's month + 4 days) <= 4."""
    return F.dayofmonth(F.date_add(F.make_date(F.year(d), F.month(d), F.lit(28)), 4)) <= 4


def fixed_span(spark, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.lit(start).cast("date").alias("start_date"),
                                 F.lit(end).cast("date").alias("end_date"))


def kpi_customer_summary(dim: DataFrame, measurement_date: str, batch_id: str, created_at) -> DataFrame:
    """Global KPI row over current dimension rows (partial + final aggregate;
    the only shuffle is the exact distinct count of email domains)."""
    cur = dim.filter(F.col("is_current"))
    seg = F.col("customer_segment")
    stats = cur.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("is_active")).alias("active_customers"),
        F.count_if(~F.col("is_active")).alias("inactive_customers"),
        F.countDistinct("email_domain").alias("unique_email_domains"),
        F.count_if(seg == "Premium").alias("premium_customers"),
        F.count_if(seg == "Standard").alias("standard_customers"),
        F.count_if(seg == "Basic").alias("basic_customers"),
    )
    total = F.col("total_customers")
    return stats.select(
        "*",
        F.when(total > 0, F.col("active_customers") / total * 100).otherwise(F.lit(0.0))
        .alias("active_customer_rate"),
        F.when(total > 0, F.col("premium_customers") / total * 100).otherwise(F.lit(0.0))
        .alias("premium_customer_rate"),
        F.lit(measurement_date).cast("date").alias("measurement_date"),
        F.lit(batch_id).alias("batch_id"),
        _ts(created_at).alias("created_at"),
    )


def orders_summary_view(orders: DataFrame) -> DataFrame:
    """COUNT(*), conditional SUM, MIN and MAX of the creation date."""
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).alias("open_orders"),
        F.min("o_orderdate").alias("first_order_date"),
        F.max("o_orderdate").alias("last_order_date"),
    )


def gold_stats(object_counts: DataFrame, batch_id: str) -> DataFrame:
    """From (object_name, records, success) rows: objects ok, records,
    success rate = ok / total * 100."""
    return object_counts.agg(
        F.count(F.lit(1)).alias("objects_total"),
        F.count_if(F.col("success")).alias("objects_processed"),
        F.sum("records").alias("total_records_created"),
    ).select(
        F.lit(batch_id).alias("batch_id"), "*",
        F.when(F.col("objects_total") > 0, F.col("objects_processed") / F.col("objects_total") * 100)
        .otherwise(F.lit(0.0)).alias("success_rate"),
    )

"""Silver: current-row filter, rule evaluation, clean rows, quarantine rows.

One projection computes every rule; the clean and quarantine outputs are two
filters of it. Keys are deterministic, so evaluating the projection once per
sink gives identical results (no uuid()/now() inside the plan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import JSON_OPTIONS, uuid_from_md5
from ..functions.rules import first_failure

ERR = "_err"

# The bronze columns that the silver customer is made of.
SILVER_CUSTOMER_SOURCE = (
    "br_customer_key", "customer_id", "store_id", "first_name", "last_name", "email",
    "address_id", "activebool", "create_date", "last_update", "active",
    "br_load_time", "br_batch_id", "br_record_hash",
)


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp_ntz")


def current_rows(bronze: DataFrame, cols=SILVER_CUSTOMER_SOURCE) -> DataFrame:
    """Rows flagged current; the filter pushes down to the parquet scan."""
    return bronze.filter(F.col("br_is_current")).select(*cols)


def validate(df: DataFrame, rules) -> DataFrame:
    """Adds ``_err`` (first failing rule's error struct, NULL if valid) and
    one ``_v_<field>`` cleaned value per rule."""
    values = {f"_v_{r.field}": r.value for r in rules if r.value is not None}
    return df.withColumns({ERR: first_failure(rules), **values})


def clean(validated: DataFrame, rules, key_col: str, batch_id: str, load_ts,
          silver_table: str = "sl_customer", key_name: str = "sl_customer_key",
          passthrough=()) -> DataFrame:
    """Typed clean rows plus the silver audit columns."""
    typed = [F.col(f"_v_{r.field}").alias(r.field) for r in rules if r.value is not None]
    return validated.filter(F.col(ERR).isNull()).select(
        *[F.col(c) for c in passthrough],
        *typed,
        uuid_from_md5(silver_table, batch_id, F.col(key_col)).alias(key_name),
        F.col(key_col).alias("br_source_key"),
        _ts(load_ts).alias("sl_load_time"),
        F.lit(batch_id).alias("sl_batch_id"),
    )


def quarantine(validated: DataFrame, record_cols, key_col: str, batch_id: str, created_at,
               source_table: str = "br_customer", target_table: str = "sl_customer",
               severity: str = "MEDIUM") -> DataFrame:
    """One row per failing record with the full bronze record as JSON."""
    e = F.col(ERR)
    return validated.filter(e.isNotNull()).select(
        uuid_from_md5("error", source_table, batch_id, F.col(key_col)).alias("error_id"),
        F.col(key_col).alias("br_source_key"),
        F.lit(source_table).alias("source_table"),
        F.lit(target_table).alias("target_table"),
        F.lit(batch_id).alias("batch_id"),
        F.to_json(F.struct(*[F.col(c) for c in record_cols]), JSON_OPTIONS).alias("bronze_record_json"),
        e["category"].alias("error_category"),
        e["message"].alias("error_message"),
        e["failed_field"].alias("failed_field"),
        e["expected_value"].alias("expected_value"),
        e["actual_value"].alias("actual_value"),
        F.lit(f"{source_table}_to_{target_table}_validation").alias("transformation_rule"),
        F.lit(severity).alias("severity"),
        F.lit("PENDING").alias("remediation_status"),
        _ts(created_at).alias("created_at"),
        F.lit(0).alias("retry_count"),
        F.lit(False).alias("alert_sent"),
    )


def promotion_stats(validated: DataFrame, table: str) -> DataFrame:
    """processed / promoted / quarantined / success_rate in one aggregate."""
    ok = F.col(ERR).isNull()
    agg = validated.agg(
        F.count(F.lit(1)).alias("records_processed"),
        F.count_if(ok).alias("records_promoted"),
        F.count_if(~ok).alias("records_quarantined"),
    )
    return agg.select(
        F.lit(table).alias("table_name"), "*",
        F.when(F.col("records_processed") > 0,
               F.col("records_promoted") / F.col("records_processed") * 100).otherwise(F.lit(0.0))
        .alias("success_rate"),
    )


def promote(bronze: DataFrame, rules, key_col: str, batch_id: str, load_ts, record_cols=None,
            source_table: str = "br_customer", target_table: str = "sl_customer",
            key_name: str | None = None, passthrough=()):
    """Generic promoter: returns (clean, quarantine, stats) DataFrames."""
    record_cols = list(record_cols or bronze.columns)
    v = validate(bronze, rules)
    key_name = key_name or f"{target_table}_key"
    return (clean(v, rules, key_col, batch_id, load_ts, target_table, key_name, passthrough),
            quarantine(v, record_cols, key_col, batch_id, load_ts, source_table, target_table),
            promotion_stats(v, target_table))


def first_failure_view(validated: DataFrame, key_col: str) -> DataFrame:
    e = F.col(ERR)
    return validated.select(
        F.col(key_col),
        e.isNull().alias("is_valid"),
        e["category"].alias("error_category"),
        e["failed_field"].alias("failed_field"),
        e["message"].alias("error_message"),
        e["actual_value"].alias("actual_value"),
    )


def derive(silver: DataFrame, as_of: str, source_system: str = "pagila") -> DataFrame:
    """Declared silver extras: full_name, email_domain, tenure, email
    validity, source system, and a quality score = share of the nullable
    fields (email, address_id, create_date, last_update) that are present."""
    em = F.col("email")
    valid_email = (em.isNotNull() & em.contains("@")
                   & F.split_part(em, F.lit("@"), F.lit(2)).contains("."))
    present = sum(F.col(c).isNotNull().cast("int") for c in ("email", "address_id", "create_date", "last_update"))
    return silver.select(
        "sl_customer_key", "customer_id",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        F.when(em.contains("@"), F.split_part(em, F.lit("@"), F.lit(2))).alias("email_domain"),
        F.datediff(F.lit(as_of).cast("date"), F.to_date("create_date")).alias("customer_tenure_days"),
        F.coalesce(valid_email, F.lit(False)).alias("is_email_valid"),
        F.lit(source_system).alias("sl_source_system"),
        (present / F.lit(4.0)).alias("sl_data_quality_score"),
    )

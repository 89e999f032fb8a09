"""Bronze ingest with a dead-letter queue.

Contract rules run as one projection over the source rows; good rows get
the bronze audit columns, failing rows become DLQ records. Both outputs
are filters of the same deterministic projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import JSON_OPTIONS, sha256_record_hash, uuid_from_md5

# DLQ wording and classes.
SOURCE_SYSTEM = "pagila"
SCHEMA_VALIDATION = "SCHEMA_VALIDATION"
CONSTRAINT_VIOLATION = "CONSTRAINT_VIOLATION"
UNKNOWN_ERROR = "UNKNOWN_ERROR"
NULL_TYPE_MESSAGE = "customer_id must be integer, got <class 'NoneType'>"
FLOAT_TYPE_MESSAGE = "customer_id must be integer, got <class 'float'>"
# a number with a decimal point or exponent, as a float prints
FRACTION_PATTERN = r"^[+-]?([0-9]+[.][0-9]*|[.][0-9]+|[0-9]+)([eE][+-]?[0-9]+)?$"
EMAIL_MESSAGE_PREFIX = "Invalid email format: "
# Field names looked for in an error message, in this order.
MESSAGE_FIELDS = ("customer_id", "email", "first_name", "last_name")
# Expected-type words looked for in the lower-cased message, in this order.
EXPECTED_TYPES = (("integer", "integer"), ("email", "email_format"), ("date", "date"))
ACTUAL_MAX = 500

DLQ_ERR = "_dlq"


def customer_contract_error() -> Column:
    """br_customer contract: customer_id present and no fraction; email, if present, has '@'.
    Returns NULL or struct(error_type, error_message)."""
    cid, em = F.col("customer_id"), F.col("email")
    fraction = cid.cast("string").rlike(FRACTION_PATTERN) & cid.cast("string").rlike("[.eE]")
    return (F.when(cid.isNull(), F.struct(F.lit(SCHEMA_VALIDATION).alias("error_type"),
                                          F.lit(NULL_TYPE_MESSAGE).alias("error_message")))
            .when(fraction, F.struct(F.lit(SCHEMA_VALIDATION).alias("error_type"),
                                     F.lit(FLOAT_TYPE_MESSAGE).alias("error_message")))
            .when(em.isNotNull() & ~em.cast("string").contains("@"),
                  F.struct(F.lit(SCHEMA_VALIDATION).alias("error_type"),
                           F.concat(F.lit(EMAIL_MESSAGE_PREFIX), em.cast("string")).alias("error_message"))))


def extract_failed_field(message: Column) -> Column:
    out = F.lit(None).cast("string")
    for f in reversed(MESSAGE_FIELDS):
        out = F.when(message.contains(f), F.lit(f)).otherwise(out)
    return out


def extract_expected_type(message: Column) -> Column:
    low = F.lower(message)
    out = F.lit(None).cast("string")
    for word, kind in reversed(EXPECTED_TYPES):
        out = F.when(low.contains(word), F.lit(kind)).otherwise(out)
    return out


def classify(exception_class: Column) -> Column:
    """Exception class name -> DLQ error type."""
    return (F.when(exception_class.isin("TypeError", "ValueError"), SCHEMA_VALIDATION)
            .when(exception_class.isin("IntegrityError", "DataError"), CONSTRAINT_VIOLATION)
            .otherwise(UNKNOWN_ERROR))


def _actual_value(df: DataFrame, field: Column) -> Column:
    out = F.lit("N/A")
    for f in reversed(MESSAGE_FIELDS):
        if f in df.columns:
            out = F.when(field == f, F.coalesce(F.col(f).cast("string"), F.lit("None"))).otherwise(out)
    return F.substring(out, 1, ACTUAL_MAX)


def checked(source: DataFrame, contract: Column | None = None) -> DataFrame:
    return source.withColumn(DLQ_ERR, contract if contract is not None else customer_contract_error())


def good_rows(chk: DataFrame, table: str, batch_id: str, load_ts, key_col: str = "customer_id") -> DataFrame:
    src = [c for c in chk.columns if c != DLQ_ERR]
    return chk.filter(F.col(DLQ_ERR).isNull()).select(
        *src,
        F.lit(load_ts).cast("timestamp_ntz").alias("br_load_time"),
        F.lit(f"{table}_{batch_id}").alias("br_source_file"),
        F.lit(batch_id).alias("br_batch_id"),
        F.lit(True).alias("br_is_current"),
        uuid_from_md5(table, batch_id, F.col(key_col), sha256_record_hash(src)).alias(f"br_{table}_key"),
    )


def dlq_rows(chk: DataFrame, table: str, batch_id: str) -> DataFrame:
    src = [c for c in chk.columns if c != DLQ_ERR]
    e = F.col(DLQ_ERR)
    msg = e["error_message"]
    field = extract_failed_field(msg)
    return chk.filter(e.isNotNull()).select(
        F.lit(table).alias("source_table"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.lit(batch_id).alias("batch_id"),
        F.to_json(F.struct(*[F.col(c) for c in src]), JSON_OPTIONS).alias("raw_record"),
        e["error_type"].alias("error_type"),
        msg.alias("error_message"),
        field.alias("failed_field"),
        extract_expected_type(msg).alias("expected_type"),
        _actual_value(chk, field).alias("actual_value"),
    )


def dlq_model_rows(dlq: DataFrame, created_at) -> DataFrame:
    """DLQ rows completed to the declared error-table model."""
    return dlq.select(
        uuid_from_md5("dlq", F.col("source_table"), F.col("batch_id"), F.col("raw_record")).alias("error_id"),
        "*",
        F.lit("PENDING").alias("remediation_status"),
        F.lit(None).cast("string").alias("remediation_notes"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
        F.lit(0).alias("retry_count"),
    )


def summary(chk: DataFrame) -> DataFrame:
    """processed / success / failed / success_rate (2 decimals) / has_errors."""
    bad = F.col(DLQ_ERR).isNotNull()
    s = chk.agg(F.count(F.lit(1)).alias("records_processed"),
                F.count_if(~bad).alias("records_success"),
                F.count_if(bad).alias("records_failed"))
    p = F.col("records_processed")
    return s.select(
        F.lit(1).alias("tables_processed"), "*",
        F.round(F.when(p > 0, F.col("records_success") / p * 100).otherwise(F.lit(0.0)), 2).alias("success_rate"),
        (F.col("records_failed") > 0).alias("has_errors"),
    )

"""Quarantine replay and reporting.

Replay parses the stored bronze record back from JSON, applies repair
expressions, and runs the very same rule set: rows that now pass are
promoted (status RESOLVED), the rest stay PENDING with retry_count + 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import silver as S


def parse_records(quarantine: DataFrame, fields) -> DataFrame:
    """Quarantine rows with the bronze record's fields as text columns."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return quarantine.withColumn("_rec", F.from_json("bronze_record_json", schema)) \
        .select("*", *[F.col(f"_rec.{f}").alias(f) for f in fields]).drop("_rec")


def replay(quarantine: DataFrame, fields, fixes: dict, rules, retried_at) -> tuple[DataFrame, DataFrame]:
    """Returns (updated quarantine rows, promoted records)."""
    parsed = parse_records(quarantine, fields)
    fixed = parsed.withColumns({f: e for f, e in fixes.items()}) if fixes else parsed
    v = S.validate(fixed, rules)
    err = F.col(S.ERR)
    resolved = err.isNull()
    updated = v.select(
        "error_id", "br_source_key", "source_table", "target_table", "batch_id",
        F.when(resolved, F.lit("RESOLVED")).otherwise(F.lit("PENDING")).alias("remediation_status"),
        (F.col("retry_count") + 1).alias("retry_count"),
        F.lit(retried_at).cast("timestamp_ntz").alias("last_retry_at"),
        err["category"].alias("error_category"),
        err["failed_field"].alias("failed_field"),
        err["message"].alias("error_message"),
    )
    promoted = v.filter(resolved).select(
        *[F.col(f"_v_{r.field}").alias(r.field) for r in rules if r.value is not None],
        F.col("br_source_key"))
    return updated, promoted


def report(quarantine: DataFrame) -> DataFrame:
    """Errors by category, field and severity, every group."""
    return quarantine.groupBy("error_category", "failed_field", "severity") \
        .agg(F.count(F.lit(1)).alias("errors"))


# Repairs used by the replay query (strip an 'X' id prefix,
# a '.0' suffix on integers, and spelled-out flags).
def default_fixes() -> dict[str, Column]:
    return {
        "customer_id": F.regexp_replace("customer_id", "^X", ""),
        "store_id": F.regexp_replace("store_id", r"\.0$", ""),
        "active": F.when(F.col("active") == "one", F.lit("1")).otherwise(F.col("active")),
    }

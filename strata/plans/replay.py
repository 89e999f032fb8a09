"""Quarantine replay as a job that writes back.

Two tables change: repaired rows go to silver, and the quarantine batch gets the outcome. Spark writes one table at a time, so the replay
first stages the whole new quarantine batch under its own id, then writes both tables from the staged rows. Stopped anywhere, it is run again with the
same id: before the staging is whole, nothing has changed; once it is (its ``_SUCCESS`` marker), both writes are made again from it and
give what they gave before. So a replay that is run twice changes nothing, and a quarantine folder that was half rewritten is whole again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quarantine as QR, silver as S
from ..sources import sinks

ERRORS, STAGED = "silver/sl_transformation_errors", "silver/staged_replays"
# Fixed value: how a replay resolves an error, one of the declared resolution methods.
METHOD = "RULE_UPDATE"
OUTCOME = {"last_retry_at": "timestamp_ntz", "remediation_notes": "string", "resolved_at": "timestamp_ntz", "resolution_method": "string"}


def silver_batch(batch_id: str, replay_id: str) -> str:
    """The silver batch of a replay's rows: beside the batch they come from, so that either can be written again."""
    return f"{batch_id}.{replay_id}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def outcome(errors: DataFrame, fields, fixes: dict, rules, replay_id: str, replayed_at) -> DataFrame:
    """The quarantine rows after the replay, and ``_resolved``: whether this replay resolved them. Only PENDING rows are tried: one that passes the
    rules after the repairs is RESOLVED, with the repaired fields in its notes; another stays PENDING, with its count raised and the rule that
    fails now in its notes."""
    now = F.lit(replayed_at).cast("timestamp_ntz")
    old = errors.withColumns({c: F.lit(None).cast(t) for c, t in OUTCOME.items() if c not in errors.columns})
    before = QR.parse_records(old, fields).withColumn("_before", F.struct(*[F.col(f) for f in fields]))
    v = S.validate(before.withColumns(dict(fixes)), rules)
    err = F.col(S.ERR)
    tried = F.col("remediation_status") == "PENDING"
    passed = tried & err.isNull()
    repaired = F.concat_ws(", ", *[F.when(~F.col(f"_before.{f}").eqNullSafe(F.col(f)), F.lit(f)) for f in fields])
    notes = (F.when(passed, F.concat(F.lit(f"replay {replay_id}: repaired "), repaired))
             .otherwise(F.concat(F.lit(f"replay {replay_id}: still "), err["category"], F.lit(" in "), err["failed_field"])))
    new = {"remediation_status": F.when(passed, "RESOLVED").otherwise(F.col("remediation_status")),
           "retry_count": F.col("retry_count") + F.when(tried, 1).otherwise(0), "last_retry_at": F.when(tried, now).otherwise(F.col("last_retry_at")),
           "remediation_notes": F.when(tried, notes).otherwise(F.col("remediation_notes")),
           "resolved_at": F.when(passed, now).otherwise(F.col("resolved_at")),
           "resolution_method": F.when(passed, METHOD).otherwise(F.col("resolution_method"))}
    return v.select(*[new.get(c, F.col(c)).alias(c) for c in old.columns], F.coalesce(passed, F.lit(False)).alias("_resolved"))


def promoted(staged: DataFrame, fields, fixes: dict, rules, batch_id: str, replayed_at, silver_table: str) -> DataFrame:
    """The rows that the replay resolved, repaired and typed as the first promotion would have."""
    fixed = QR.parse_records(staged.filter("_resolved").select("br_source_key", "bronze_record_json"), fields).withColumns(dict(fixes))
    return S.clean(S.validate(fixed, rules), rules, "br_source_key", batch_id, replayed_at, silver_table, f"{silver_table}_key")


def replay_batch(spark: SparkSession, lake: str, batch_id: str, replay_id: str, fields, fixes: dict, rules, replayed_at,
                 silver_table: str = "sl_customer") -> dict:
    """Replays the PENDING rows of one quarantine batch. Returns the rows promoted and the rows of the quarantine batch."""
    errors, stage = f"{lake}/{ERRORS}", f"{lake}/{STAGED}/{replay_id}"
    staged = sinks.batch_path(stage, "batch_id", batch_id)
    if not _exists(spark, f"{staged}/_SUCCESS"):
        current = spark.read.option("basePath", errors).parquet(sinks.batch_path(errors, "batch_id", batch_id))
        sinks.write_batch(outcome(current, fields, fixes, rules, replay_id, replayed_at), stage, "batch_id", batch_id)
    rows = spark.read.option("basePath", stage).parquet(staged)
    own = silver_batch(batch_id, replay_id)
    n = sinks.write_batch(promoted(rows, fields, fixes, rules, own, replayed_at, silver_table), f"{lake}/silver/{silver_table}", "sl_batch_id", own)
    return {"promoted": n, "quarantine": sinks.write_batch(rows.drop("_resolved"), errors, "batch_id", batch_id)}

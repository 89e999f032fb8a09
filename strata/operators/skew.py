"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed partition of a sort-merge join only when both inputs are
plain shuffles; a join against an aggregated side (distinct keys, counts) is
not split, so a key holding a third of the rows would land in one task.
``salted_join`` splits such keys itself: keys of ``left`` with more than
``max_key_rows`` rows are found by one map-side-combined count, each of
their rows gets one of ceil(rows / max_key_rows) salt values, and the
matching ``right`` row (at most one per key) is copied once per salt value.
The join then runs on (key, salt). Every row is kept, and the result equals
the plain join. Salts are content hashes, so they are deterministic under
task retries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

# Rows one task should at most take for a single key.
DEFAULT_MAX_KEY_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys, max_key_rows: int = DEFAULT_MAX_KEY_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """(keys..., _salts) for keys holding more than ``max_key_rows`` rows.
    There are at most rows / max_key_rows of them, whatever the data: that
    bound is what allows broadcasting the result."""
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if counts is None else counts
    return (counts.filter(F.col("_n") > F.lit(int(max_key_rows)))
            .select(*keys, F.ceil(F.col("_n") / F.lit(int(max_key_rows))).cast("int").alias("_salts")))


def salted_join(left: DataFrame, right: DataFrame, keys, how: str = "left",
                max_key_rows: int = DEFAULT_MAX_KEY_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """``left.join(right, keys, how)`` for a ``right`` with at most one row
    per key (``how`` in inner / left), with hot keys of ``left`` spread over
    several tasks. ``counts``: (keys..., _n) rows of ``left`` per key, if a
    caller has them, for the keys of ``right`` at least."""
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    keys = list(keys)
    hot = F.broadcast(hot_keys(left, keys, max_key_rows, counts))   # bounded: see hot_keys
    # Every salt copy of a right row is identical, so any salt assignment
    # gives the same result. The salt is a hash of the row's content, so a
    # retried map task sends every row to the same reducer as before. (A
    # position-based id would not do that when the input order can change.)
    # The number of the map partition goes into the hash, so exact duplicates
    # spread as well, as far as they lie in different partitions.
    content = [F.col(f.name) for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.pmod(F.xxhash64(F.col("_part"), *content), F.col("_salts"))
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # rows with a NULL key match nothing: they skip the join
    without = left.filter(~has_key) if how == "left" else None
    salted = left.filter(has_key).withColumn("_part", F.spark_partition_id()).join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNull(), F.lit(0).cast("bigint")).otherwise(salt)).drop("_salts", "_part")
    copies = right.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - F.lit(1)))) \
        .drop("_salts")
    out = salted.join(copies, keys + ["_salt"], how).drop("_salt")
    return out if without is None else out.unionByName(without, allowMissingColumns=True)

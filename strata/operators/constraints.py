"""Set rules of a bronze batch, beside the row rules of ``operators.dlq``: uniqueness inside the batch and against stored bronze, and the
existence of a parent. Whether a row breaks one depends on other rows, so each is a count per key, combined before its shuffle, from which
the few faulty keys are joined back to the rows. A faulty key that holds a large share of the rows is spread over tasks (``operators.skew``).

Rows are told apart by where they are stored: the batch is landed first, and Spark's hidden ``_metadata`` column names each row's file and
place in it. So of equal rows one can be kept, and a repeated task gives every row the name it had.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources import sinks
from .dlq import DLQ_ERR, classify
from .skew import DEFAULT_MAX_KEY_ROWS, salted_join

ROW_ID = "_row_id"
# Exception classes that the rules stand for, as the error classifier knows them.
INTEGRITY, DATA, SEVERAL_FOUND = "IntegrityError", "DataError", "MultipleResultsFound"


def error(exception_class: str, message: Column) -> Column:
    """(error_type, error_message) of a rule that stands for an exception class."""
    return F.struct(classify(F.lit(exception_class)).alias("error_type"), message.alias("error_message"))


def text(c: str) -> Column:
    return F.col(c).cast("string")


@dataclass(frozen=True)
class MaxLength:
    column: str
    most: int

    def broken(self) -> Column:
        return F.when(F.length(text(self.column)) > self.most, error(DATA, F.lit(f"value too long for {self.column}, at most {self.most}")))


@dataclass(frozen=True)
class Between:
    """A number in a text column; what is no number is another rule's business."""
    column: str
    low: int
    high: int

    def broken(self) -> Column:
        v = F.col(self.column).try_cast("decimal(38,6)")
        return F.when((v < self.low) | (v > self.high), error(DATA, F.concat(F.lit(f"{self.column} is out of range: "), text(self.column))))


@dataclass(frozen=True)
class Unique:
    """No two rows of the batch, and no row and one of ``stored``, share a key without NULL. The row that comes first in the landed batch stays."""
    columns: Sequence[str]
    stored: DataFrame | None = None


@dataclass(frozen=True)
class Parent:
    """A value that is not NULL is held by exactly one row of ``parents`` (compared as text). By none: a broken reference; by several: a
    lookup without a definite answer."""
    column: str
    parents: DataFrame
    parent_column: str


def land(batch: DataFrame, path: str, batch_id: str) -> DataFrame:
    """Writes a batch to its folder under ``path`` (a rerun replaces it) and reads it back with ``ROW_ID``."""
    spark: SparkSession = batch.sparkSession
    sinks.write_batch(batch, path, "_landed_batch", batch_id)
    stored = spark.read.schema(batch.schema).parquet(sinks.batch_path(path, "_landed_batch", batch_id))
    return stored.select("*", F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")).alias(ROW_ID))


def _whole(columns) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def _key_errors(rows: DataFrame, columns, counts: DataFrame, faulty: DataFrame, broken: Column, max_key_rows: int) -> DataFrame:
    """``rows`` with their error, or ``broken`` (over the columns of ``faulty``) where they have none. Only sound rows with a whole key are joined."""
    sound = F.col(DLQ_ERR).isNull() & _whole(columns)
    names = rows.columns
    joined = salted_join(rows.filter(sound), faulty, columns, "left", max_key_rows, counts=counts)
    judged = joined.select(*[F.coalesce(DLQ_ERR, broken).alias(c) if c == DLQ_ERR else F.col(c) for c in names])
    return judged.unionByName(rows.filter(~sound))


def apply_unique(rows: DataFrame, rule: Unique, max_key_rows: int) -> DataFrame:
    columns = list(rule.columns)
    sound = rows.filter(F.col(DLQ_ERR).isNull() & _whole(columns))
    counts = sound.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"), F.min(ROW_ID).alias("_first"))
    found = counts.withColumn("_stored", F.lit(None).cast("boolean"))
    if rule.stored is not None:
        known = rule.stored.select(*columns).dropna().distinct().withColumn("_stored", F.lit(True))
        found = counts.join(known, columns, "left")
    faulty = found.filter((F.col("_n") > 1) | F.col("_stored")).select(*columns, "_first", "_stored")
    name = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), text(c)) for c in columns])
    broken = (F.when(F.col("_stored"), error(INTEGRITY, F.concat(F.lit("key is stored already: "), name)))
              .when(F.col("_first").isNotNull() & (F.col(ROW_ID) != F.col("_first")), error(INTEGRITY, F.concat(F.lit("duplicate key: "), name))))
    return _key_errors(rows, columns, counts.select(*columns, "_n"), faulty, broken, max_key_rows)


def apply_parent(rows: DataFrame, rule: Parent, max_key_rows: int) -> DataFrame:
    c = rule.column
    sound = rows.filter(F.col(DLQ_ERR).isNull() & F.col(c).isNotNull())
    counts = sound.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    parents = rule.parents.select(F.col(rule.parent_column).cast("string").alias("_parent")).dropna().groupBy("_parent").agg(F.count(F.lit(1)).alias("_parents"))
    found = counts.join(parents, F.col(c).cast("string") == F.col("_parent"), "left")
    faulty = found.filter(F.col("_parents").isNull() | (F.col("_parents") > 1)).select(c, F.coalesce("_parents", F.lit(0)).alias("_parents"))
    broken = (F.when(F.col("_parents") == 0, error(INTEGRITY, F.concat(F.lit(f"no parent for {c}="), text(c))))
              .when(F.col("_parents") > 1, error(SEVERAL_FOUND, F.concat(F.lit(f"several parents for {c}="), text(c)))))
    return _key_errors(rows, [c], counts, faulty, broken, max_key_rows)


def apply(rows: DataFrame, rules, max_key_rows: int = DEFAULT_MAX_KEY_ROWS) -> DataFrame:
    """``rows`` (landed, with ``DLQ_ERR`` of the row contract) with the first broken rule in the order given. A row that breaks a rule takes no part in
    those behind it: it would never have been stored."""
    for rule in rules:
        if isinstance(rule, Unique):
            rows = apply_unique(rows, rule, max_key_rows)
        elif isinstance(rule, Parent):
            rows = apply_parent(rows, rule, max_key_rows)
        else:
            rows = rows.withColumn(DLQ_ERR, F.coalesce(DLQ_ERR, rule.broken()))
    return rows

"""Bronze projections: stringify, audit profiles, record hashes, keys, typing.

All operators are narrow projections (no shuffle); they fuse into the scan's
whole-stage-codegen stage.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..contracts import TypedContract
from ..functions.hashing import md5_record_hash, record_json, sha256_record_hash, uuid_from_md5

_COMPLEX = (T.ArrayType, T.MapType, T.StructType)


def _ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def stringify(df: DataFrame, carry=()) -> DataFrame:
    """Lenient typing: every column becomes text; NULL stays NULL. Columns of ``carry`` stay as they are."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in carry:
            cols.append(c)
        elif isinstance(f.dataType, _COMPLEX):
            cols.append(F.to_json(c).alias(f.name))
        elif isinstance(f.dataType, T.BinaryType):
            cols.append(F.base64(c).alias(f.name))
        else:
            cols.append(c.cast("string").alias(f.name))
    return df.select(*cols)


def audit_lenient(df: DataFrame, table: str, batch_id: str, load_ts, key_cols=(), carry=()) -> DataFrame:
    """Lenient bronze profile: br_{t}_key, br_load_time, br_source_file,
    br_record_hash (SHA-256 of the non-audit fields), br_is_current, br_batch_id. Columns of ``carry`` are no fields of the
    record: they are handed on behind the others."""
    source_cols = [c for c in df.columns if not c.startswith("br_") and c not in carry]
    with_hash = df.withColumn("br_record_hash", sha256_record_hash(source_cols))
    key = uuid_from_md5(table, batch_id, *[F.col(k) for k in key_cols], F.col("br_record_hash"))
    return with_hash.select(
        *[F.col(c) for c in source_cols],
        key.alias(f"br_{table}_key"),
        _ts(load_ts).alias("br_load_time"),
        F.lit(f"{table}_{batch_id}").alias("br_source_file"),
        F.col("br_record_hash"),
        F.lit(True).alias("br_is_current"),
        F.lit(batch_id).alias("br_batch_id"),
        *carry,
    )


SNAPSHOT_AUDIT = ("br_load_time", "br_source_table", "br_batch_id", "br_is_current", "br_record_hash")


def audit_snapshot(df: DataFrame, table: str, batch_id: str, load_ts, source_schema: str = "public") -> DataFrame:
    """Snapshot profile: br_load_time, br_source_table, br_batch_id,
    br_is_current and an MD5 hash of all non-audit columns in table order."""
    cols = [c for c in df.columns if c not in SNAPSHOT_AUDIT]
    return df.select(
        *cols,
        _ts(load_ts).alias("br_load_time"),
        F.lit(f"{source_schema}.{table}").alias("br_source_table"),
        F.lit(batch_id).alias("br_batch_id"),
        F.lit(True).alias("br_is_current"),
        md5_record_hash(cols).alias("br_record_hash"),
    )


def audit_sqlserver(df: DataFrame, schema: str, table: str, load_ts, system: str = "sqlserver") -> DataFrame:
    """SQL-Server bronze profile: _bronze_loaded_at/_source_system/_source_schema/_source_table."""
    return df.withColumns({
        "_bronze_loaded_at": _ts(load_ts),
        "_bronze_source_system": F.lit(system),
        "_bronze_source_schema": F.lit(schema),
        "_bronze_source_table": F.lit(table),
    })


def audit_extended(df: DataFrame, schema: str, table: str, load_ts, batch_id: str) -> DataFrame:
    """Extended SQL-Server profile: adds _bronze_batch_id, _bronze_row_hash
    (SHA-256 of the source columns) and _bronze_is_deleted=false. Columns
    already present are left untouched, so applying it twice is a no-op."""
    source_cols = [c for c in df.columns if not c.startswith("_bronze_")]
    wanted = {
        "_bronze_loaded_at": _ts(load_ts),
        "_bronze_source_system": F.lit("sqlserver"),
        "_bronze_source_schema": F.lit(schema),
        "_bronze_source_table": F.lit(table),
        "_bronze_batch_id": F.lit(batch_id),
        "_bronze_row_hash": sha256_record_hash(source_cols),
        "_bronze_is_deleted": F.lit(False),
    }
    return df.withColumns({k: v for k, v in wanted.items() if k not in df.columns})


def conform_typed(df: DataFrame, contract: TypedContract) -> DataFrame:
    """Typed bronze: cast each column to its contract type and apply renames.
    The default stands for a missing (NULL) value only. An unreadable value
    becomes NULL in the row, and ``unreadable`` returns it for quarantine."""
    out = []
    for c in contract.columns:
        v = F.col(c.name).try_cast(c.sql_type)
        if c.default is not None:
            v = F.when(F.col(c.name).isNull(), F.lit(c.default).cast(c.sql_type)).otherwise(v)
        out.append(v.alias(c.rename or c.name))
    return df.select(*out)


def unreadable(df: DataFrame, contract: TypedContract, batch_id: str) -> DataFrame:
    """One row per value that ``conform_typed`` cannot read as its contract
    type, with the whole source record."""
    faults = F.array(*[F.when(F.col(c.name).isNotNull() & F.col(c.name).try_cast(c.sql_type).isNull(), F.struct(
        F.lit(c.name).alias("failed_field"), F.col(c.name).cast("string").alias("actual_value"),
        F.lit(c.sql_type).alias("expected_type"))) for c in contract.columns])
    found = df.select(record_json(df.columns).alias("raw_record"), F.explode(F.filter(faults, lambda x: x.isNotNull())).alias("_f"))
    return found.select(F.lit(contract.table).alias("source_table"), F.lit(batch_id).alias("batch_id"), "_f.*", "raw_record")


def apply_overrides(df: DataFrame, overrides: dict | None = None, exclude=()) -> DataFrame:
    """Per-column SQL expression overrides (e.g. a CAST) and column exclusion."""
    overrides = overrides or {}
    cols = []
    for c in df.columns:
        if c in exclude:
            continue
        cols.append(F.expr(overrides[c]).alias(c) if c in overrides else F.col(c))
    return df.select(*cols)


def target_name(pattern: str, **parts) -> str:
    """Bronze target naming, e.g. '{schema}_{table}' or 'br_{table}'."""
    return pattern.format(**parts)


@dataclass(frozen=True)
class Target:
    """Where a naming pattern puts a table: the layer's folder, the table's name, and whether every load day is a partition of it."""
    layer: str
    table: str
    by_date: bool

    def path(self, lake: str) -> str:
        return f"{lake}/{self.layer}/{self.table}"


def resolve_target(pattern: str, schema: str, table: str, env: str | None = None) -> Target:
    """'bronze_{env}.{schema}_{table}_{date}' and the like: what stands before the first dot names the layer ('bronze' without a dot), ``{env}`` the
    environment, and ``{date}`` stands for a partition column instead of a part of the name, so that all days are one table. A pattern with ``{env}`` needs an
    environment; names may hold letters, digits and underscores only."""
    if "{env}" in pattern and not env:
        raise ValueError("the pattern names an environment, but there is none")
    layer, name = pattern.split(".", 1) if "." in pattern else ("bronze", pattern)
    if "{date}" in layer:
        raise ValueError("a day cannot name a layer")
    bare = re.sub(r"_?\{date\}", "", name) if not name.startswith("{date}") else re.sub(r"^\{date\}_?", "", name)
    out = Target(target_name(layer, env=env), target_name(bare, schema=schema, table=table, env=env), "{date}" in name)
    if not all(re.fullmatch(r"\w+", x) for x in (out.layer, out.table)):
        raise ValueError(f"no name for a folder: {out.layer}.{out.table}")
    return out

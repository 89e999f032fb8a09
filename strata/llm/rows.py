"""Rows that travel through Arrow functions as one struct, whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def quoted(name: str) -> str:
    """The name for ``F.col``, dots and back-ticks taken literally."""
    return "`" + name.replace("`", "``") + "`"


def packed(names: list[str], alias: str = "row") -> Column:
    """A struct of the columns, fields by number: no name can clash or be read as a path."""
    return F.struct(F.lit(True).alias("here"), *[F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate(names)]).alias(alias)


def unpacked(names: list[str], alias: str = "row") -> list[Column]:
    """The columns of ``packed`` again."""
    return [F.col(f"{alias}.c{k}").alias(c) for k, c in enumerate(names)]


def others(df: DataFrame, *but: str) -> list[str]:
    """Columns of ``df`` except those named."""
    return [c for c in df.columns if c not in but]


def unused(df: DataFrame, name: str) -> str:
    """The name, or the name with underscores behind it, that no column of ``df`` has (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same(df: DataFrame) -> list[Column]:
    """All columns of ``df``, to select from a frame that has more."""
    return [F.col(quoted(c)) for c in df.columns]

"""Keys and relationships found from values alone: no names, no declared types of key.

**Inclusions.** Every non-null value of every column goes through one shuffle, with the column it comes from (value and column combine before
it). What arrives per value is the set of columns that hold it, as bits. A column is included in all columns that are in the set of each of
its values: the bitwise *and* over its values. So all pairs of columns are compared by two aggregates, and no two tables are joined.

**Keys.** Looked for level by level: single columns and pairs in every table, more columns in tables that have no key by then. One pass a table counts
rows and values and sketches the distinct values of each column. A combination is tried if no part of it is a key, none of its columns holds a NULL, and its
columns have values enough by their sketches. In a large table the values of a slice (chosen by hash, all rows are read) are counted first: one that
comes twice proves that the combination is no key, so few others are left, and of these every value of every row is counted.

Columns of numbers with fractions, arrays, maps and structures are no keys and left out. Values are compared within a class of types (whole numbers, texts, days,
times, truth values), as 128-bit hashes.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..sources.tables import local_frame
from .quality import union_all

#: Columns per word of bits.
WORD = 63
#: A column is taken to have up to its sketched number of values (2 % standard error) divided by this share.
LEAST_SHARE, SKETCH_ERROR = 0.9, 0.02
#: In tables of so many rows one of ``SLICES`` slices of the values is counted before all are.
SLICED_ROWS, SLICES = 1 << 20, 64
#: Combinations hashed in one pass over a table: compiled code of more would be too long for the JVM to optimise.
TOGETHER = 4
CLASSES = ((T.IntegralType, "whole"), (T.StringType, "text"), (T.DateType, "day"), (T.TimestampNTZType, "time"), (T.TimestampType, "time"), (T.BooleanType, "truth"))
INCLUSION_DDL = ("child_table string, child_column string, parent_table string, parent_column string, child_values bigint, parent_values bigint, "
                 "parent_unique boolean")
KEY_DDL = "table_name string, key_columns string, n_columns int"


def value_class(t: T.DataType) -> str | None:
    return next((name for kind, name in CLASSES if isinstance(t, kind)), None)


def columns_of(frames: dict) -> list[tuple[str, str, str]]:
    """(table, column, class) of the columns that can be keys."""
    return [(t, f.name, value_class(f.dataType)) for t, df in frames.items() for f in df.schema.fields if value_class(f.dataType)]


def hashed(values: list[Column]) -> list[Column]:
    return [F.xxhash64(*values).alias("h1"), F.xxhash64(F.lit(1), *values).alias("h2")]


def profile(frames: dict, columns) -> DataFrame:
    """(col, n_values, most, w0, ...) per column: its number, its different values, the rows of the most frequent one, and the bits of the columns that
    hold all its values. One shuffle of (value, column), combined before it, which the second aggregate finds dealt already by value."""
    number = {(t, c): k for k, (t, c, _) in enumerate(columns)}
    words = -(-len(columns) // WORD)
    parts = []
    for t, df in frames.items():
        mine = [(c, kind) for x, c, kind in columns if x == t]
        if mine:
            # values as text, behind the name of their class
            cells = [F.struct(F.lit(number[t, c]).alias("col"), F.concat(F.lit(kind + ":"), F.col(f"`{c}`").cast("string")).alias("v")) for c, kind in mine]
            parts.append(df.select(F.explode(F.filter(F.array(*cells), lambda x: x["v"].isNotNull())).alias("x")).select("x.col", *hashed([F.col("x.v")])))
    cells = reduce(DataFrame.unionByName, parts).groupBy("h1", "h2", "col").agg(F.count(F.lit(1)).alias("n"))   # a hot value is one row a task and column
    bit = lambda w: F.expr(f"IF(col div {WORD} = {w}, shiftleft(1L, col % {WORD}), 0L)")
    holders = cells.groupBy("h1", "h2").agg(*[F.bit_or(bit(w)).alias(f"w{w}") for w in range(words)],
                                            F.collect_list(F.struct("col", "n")).alias("cols"))   # at most one entry per column
    each = holders.select(*[f"w{w}" for w in range(words)], F.explode("cols").alias("x"))
    return each.groupBy(F.col("x.col").alias("col")).agg(F.count(F.lit(1)).alias("n_values"), F.max("x.n").alias("most"),
                                                         *[F.bit_and(f"w{w}").alias(f"w{w}") for w in range(words)])


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def inclusions(frames: dict, folder: str) -> DataFrame:
    """Every pair of different columns of which the first (child) has values and all of them are in the second (parent), with the numbers of their
    different values and whether the parent's are unique: with a unique parent a foreign key the data allow. Tables without rows have none."""
    columns = columns_of(frames)
    spark = next(iter(frames.values())).sparkSession
    if not columns:
        return local_frame(spark, [], INCLUSION_DDL)
    rows = {r.col: r for r in _stored(profile(frames, columns), folder, "columns").collect()}   # one row per column
    out = []
    for k, r in rows.items():
        held = [r[f"w{w}"] for w in range(-(-len(columns) // WORD))]
        for p in rows:
            if p != k and held[p // WORD] >> p % WORD & 1:
                out.append((*columns[k][:2], *columns[p][:2], r.n_values, rows[p].n_values, rows[p].most == 1))
    return local_frame(spark, sorted(out), INCLUSION_DDL)


def keys(frames: dict, folder: str, max_columns: int = 3) -> DataFrame:
    """The smallest keys of every table with rows: columns, and pairs of columns, that hold no NULL and no value (or combination) twice; no part of
    a key is itself one. Of three and up to ``max_columns`` columns only in tables without a smaller one."""
    columns = columns_of(frames)
    spark = next(iter(frames.values())).sparkSession
    if not columns:
        return local_frame(spark, [], KEY_DDL)
    sizes, n_values = _sketched(frames, columns)
    found: list = []
    for size in range(1, max_columns + 1):
        open_tables = [t for t in frames if sizes.get(t) and (size < 3 or t not in {k for k, _ in found})]
        tried = [(t, some) for t in open_tables for some in combinations([c for x, c, _ in columns if x == t and (x, c) in n_values], size)
                 if not any(t == k and set(key) <= set(some) for k, key in found)
                 and reduce(lambda a, b: a * b, [n_values[t, c] / LEAST_SHARE for c in some]) >= sizes[t]]
        large = [x for x in tried if sizes[x[0]] >= SLICED_ROWS]
        repeated = _repeated(frames, large, folder, f"slices_{size}", SLICES)
        left = [x for x in tried if x not in repeated]
        repeated = _repeated(frames, left, folder, f"combinations_{size}")
        found += [x for x in left if x not in repeated]
    return local_frame(spark, sorted((t, ",".join(c), len(c)) for t, c in found), KEY_DDL)


def _sketched(frames: dict, columns) -> tuple[dict, dict]:
    """Rows by table, and the sketched number of different values by (table, column) for columns without NULL; one aggregate a table."""
    names = {t: [c for x, c, _ in columns if x == t] for t in frames}
    parts = [df.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.count(F.col(f"`{c}`")) for c in names[t]]).alias("filled"),
                    F.array(*[F.approx_count_distinct(F.col(f"`{c}`"), SKETCH_ERROR) for c in names[t]]).alias("values"))
             .select(F.lit(t).alias("t"), "n", "filled", "values") for t, df in frames.items() if names[t]]
    rows = union_all(parts).collect()   # one row per table
    return {r.t: r.n for r in rows}, {(r.t, c): v for r in rows for c, filled, v in zip(names[r.t], r.filled, r["values"]) if filled == r.n}


def _cells(df: DataFrame, tried: list, slices: int) -> DataFrame:
    """(k, h1, h2) per row and combination (k, columns) whose value is in the slice, of columns without NULL."""
    if slices == 1:
        return union_all([df.select(F.lit(k).alias("k"), *hashed([F.col(f"`{c}`") for c in some])) for k, some in tried])
    parts = []
    for at in range(0, len(tried), TOGETHER):
        cells = []
        for k, some in tried[at : at + TOGETHER]:
            h1, h2 = hashed([F.col(f"`{c}`") for c in some])
            cells.append(F.when(F.pmod(h1, F.lit(slices)) == 0, F.struct(F.lit(k).alias("k"), h1, h2)))
        parts.append(df.select(F.explode(F.array(*cells)).alias("x")).where("x IS NOT NULL").select("x.*"))
    return union_all(parts)


def _repeated(frames: dict, tried: list, folder: str, name: str, slices: int = 1) -> list:
    """Those of the combinations (table, columns) that have a value twice, among the values of one of ``slices`` slices; one shuffle of (combination, value)."""
    if not tried:
        return []
    cells = union_all([_cells(frames[t], [(k, some) for k, (x, some) in enumerate(tried) if x == t], slices) for t in dict.fromkeys(t for t, _ in tried)])
    twice = cells.groupBy("k", "h1", "h2").agg(F.count(F.lit(1)).alias("n")).groupBy("k").agg(F.max("n").alias("n")).where("n > 1")
    return [tried[r.k] for r in _stored(twice, folder, name).collect()]   # at most one row per combination

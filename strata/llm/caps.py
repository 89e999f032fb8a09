"""Embedding near-duplicates by spherical-cap filters.

Filter directions are structured random product codes: the space is turned by a random rotation and cut into blocks; a
direction takes one of ``codewords`` random unit vectors in every block. A vector's product with all codewords ** blocks
directions is a sum over blocks, so a list decoder walks the blocks and drops partial sums that cannot reach the threshold any
more. A vector is listed under all directions whose cap (product of at least ``cap``) it lies in, and if these are fewer than
``least``, at a lower threshold. Two near vectors share most of their caps; those that share one meet in its bucket, and the
cosine in double precision decides. With the default code no link of the given tables is missed (see the README).

Equal vectors of one label are one class with a count. A pair that meets in several buckets counts in its first common one.
Buckets give, for every class, the number of its links and one link towards the smallest class it reaches there, not pairs;
those of more than ``block_rows`` rows are cut into blocks that are compared block by block, in tasks of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from strata.llm.components import components
from strata.llm.store import kept
from strata.llm.texts import grouped


@dataclass(frozen=True)
class Code:
    blocks: int = 3
    codewords: int = 16
    cap: float = 0.34
    least: int = 12
    block_rows: int = 1024
    seed: int = 20240611

    def words(self, size: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Rotation, the coordinates of each block, and each block's unit codewords (divided by the root of the blocks)."""
        rng = np.random.default_rng([self.seed, size])
        turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
        places = [p for p in np.array_split(np.arange(size), self.blocks) if len(p)]
        code = []
        for p in places:
            w = rng.standard_normal((self.codewords, len(p)))
            code.append(w / np.linalg.norm(w, axis=1, keepdims=True) / np.sqrt(len(places)))
        return turn, places, code


def list_decode(unit: np.ndarray, code: Code, words=None) -> list[np.ndarray]:
    """For each unit vector its directions (numbers, ascending): all with a product of at least ``cap``; where these are fewer
    than ``least``, those over the first lower threshold that gives as many."""
    turn, places, book = words or code.words(unit.shape[1])
    products = [(unit @ turn[:, p]) @ w.T for p, w in zip(places, book)]
    rest = np.cumsum([p.max(axis=1) for p in products][::-1], axis=0)[::-1]  # the most that later blocks can add
    total = len(book[0]) ** len(book)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(unit)
    todo, threshold = np.arange(len(unit)), code.cap
    while len(todo):
        row, number, sums = todo, np.zeros(len(todo), np.int64), np.zeros(len(todo))
        for k, p in enumerate(products):
            more = sums[:, None] + p[row]
            bound = rest[k + 1][row][:, None] if k + 1 < len(products) else 0.0
            i, c = np.nonzero(more + bound >= threshold)
            row, number, sums = row[i], number[i] * p.shape[1] + c, more[i, c]
        counts = np.bincount(row, minlength=len(unit))[todo]
        order = np.lexsort((number, row))
        lists = np.split(number[order], np.cumsum(np.bincount(row, minlength=len(unit)))[:-1])
        enough = counts >= min(code.least, total)
        for k in todo[enough]:
            out[k] = lists[k]
        todo, threshold = todo[~enough], threshold - 0.04
    return out


def unit_rows(raw: np.ndarray) -> np.ndarray:
    rows = raw.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # neither very long nor very short ones leave the range
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def compare(left, right, own: bool, number: int, least_cosine: float):
    """Links between two blocks of a bucket: pairs of row numbers, and which of them count in this bucket.
    A block is (unit vectors, directions of each row)."""
    close = left[0] @ right[0].T >= least_cosine
    if own:
        close = np.triu(close, 1)
    a, b = np.nonzero(close)
    if not len(a):
        return a, b, np.zeros(0, bool)

    def smaller(lists):
        rows = np.repeat(np.arange(len(lists)), [np.searchsorted(x, number) for x in lists])
        return rows, np.concatenate([x[: np.searchsorted(x, number)] for x in lists])

    (i, f), (j, g) = smaller(left[1]), smaller(right[1])
    common = np.intersect1d(f, g)
    first = np.ones(len(a), bool)
    for at in range(0, len(common), 1024):
        some = common[at : at + 1024]
        one, two = np.zeros((len(left[1]), len(some)), np.float32), np.zeros((len(right[1]), len(some)), np.float32)
        for m, rows, numbers in ((one, i, f), (two, j, g)):
            k = np.searchsorted(some, numbers)
            hit = (k < len(some)) & (some[np.minimum(k, len(some) - 1)] == numbers)
            m[rows[hit], k[hit]] = 1
        first &= (one @ two.T)[a, b] == 0
    return a, b, first


def near_duplicates(vectors: DataFrame, least_cosine: float = 0.93, code: Code = Code(), id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable,
    itself included) and kept (vec_id = component_id).

    Only vectors of equal, non-null label and equal length are compared. Vectors that are null, empty or zero or hold null, NaN or
    infinite components link with nothing. Repeated rows are vectors of their own that link to each other. A row with null vec_id counts as a
    link of others, never as smallest id, and is not kept. Other columns are not read."""
    item = vectors.schema[vector_col].dataType.elementType.typeName()
    dtype = np.dtype("<f4" if item == "float" else "<f8")
    v = F.col(vector_col)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = F.col(label_col).isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"), F.coalesce(sound, F.lit(False)).alias("sound"),
                          F.xxhash64(F.col(label_col), v).alias("h1"), F.xxhash64(F.lit("second"), F.col(label_col), v).alias("h2"))
    classes = (rows.where("sound").groupBy("h1", "h2")
               .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("times"), F.min("vec_id").alias("first")))
    classes = kept(classes.select("*", F.monotonically_increasing_id().alias("node")), "cap_classes")

    def listed(batches):
        books = {}
        for batch in batches:
            sizes = np.array(pa.compute.list_value_length(batch.column(1)))
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                raw = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, size)
                for k in range(0, len(raw), 4096):
                    some = raw[k : k + 4096]
                    lists = list_decode(unit_rows(some), code, books.setdefault(size, code.words(size)))
                    times = np.array([len(x) for x in lists])
                    at = pa.array(np.repeat(np.arange(len(some)), times))
                    own = part.slice(k, len(some))
                    yield pa.RecordBatch.from_arrays(
                        [own.column(0).take(at), pa.array(np.full(len(at), size), pa.int32()), pa.array(np.concatenate(lists).astype(np.int32)),
                         own.column(2).take(at), own.column(3).take(at), pa.array([x.tobytes() for x in some], pa.binary()).take(at),
                         pa.array([x.astype("<i4").tobytes() for x in lists], pa.binary()).take(at)],
                        names=["label", "size", "cap", "node", "times", "raw", "lists"])

    label_type = classes.schema["label"].dataType.simpleString()
    key = ["label", "size", "cap"]
    filed = classes.select("label", "v", "node", "times").mapInArrow(
        listed, f"label {label_type}, size int, cap int, node long, times long, raw binary, lists binary")
    hot = filed.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > code.block_rows)
    hot = hot.select(*key, F.ceil(F.col("n") / code.block_rows).cast("int").alias("cut"))
    cells = filed.join(hot, key, "left").withColumn("cut", F.coalesce("cut", F.lit(1)))
    cells = cells.withColumn("block", F.pmod(F.xxhash64("node"), F.col("cut")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("cut") - 1))  # the blocks it is compared with
    cells = cells.select("*", other.alias("other")).select(
        *key, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "times", "raw", "lists")
    width = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*key, "lo", "hi"]
    cells = cells.repartition(width, *order).sortWithinPartitions(*order, "node")

    def linked(batches):
        out: list[list[np.ndarray]] = [[], [], []]
        held = 0

        def emit():
            columns = [pa.array(np.concatenate(c)) for c in out]
            return pa.RecordBatch.from_arrays(columns, names=["node", "links", "least"])

        for (_, size, number, lo, hi), table in grouped(batches, len(order)):
            if table.num_rows < 2:
                continue
            node, times, block = (table.column(c).to_numpy() for c in ("node", "times", "block"))
            unit = unit_rows(np.frombuffer(b"".join(table.column("raw").to_pylist()), dtype).reshape(-1, size))
            lists = [np.frombuffer(x, "<i4") for x in table.column("lists").to_pylist()]
            if lo == hi:
                a, b, first = compare((unit, lists), (unit, lists), True, number, least_cosine)
            else:
                i, j = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
                a, b, first = compare((unit[i], [lists[k] for k in i]), (unit[j], [lists[k] for k in j]), False, number, least_cosine)
                a, b = i[a], j[b]
            if not len(a):
                continue
            n = len(node)
            links = np.bincount(a[first], times[b[first]], n) + np.bincount(b[first], times[a[first]], n)
            least = np.arange(n)  # rows are in order of node
            while True:
                new = least.copy()
                np.minimum.at(new, a, least[b])
                np.minimum.at(new, b, least[a])
                new = new[new]
                if (new == least).all():
                    break
                least = new
            some = np.flatnonzero((links > 0) | (least < np.arange(n)))
            for column, values in zip(out, (node[some], links[some].astype(np.int64), node[least[some]])):
                column.append(values)
            held += len(some)
            if held >= 50_000:
                yield emit()
                out, held = [[], [], []], 0
        if held:
            yield emit()

    found = kept(cells.mapInArrow(linked, "node long, links long, least long"), "cap_links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    near = components(found.select(F.col("least").alias("a"), F.col("node").alias("b")))
    with_first = near.join(classes.select("node", "first"), "node")
    least = with_first.groupBy("component").agg(F.min("first").alias("least"))
    moved = near.join(least, "component").select("node", "least")
    result = (classes.join(links, "node", "left").join(moved, "node", "left")
              .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("least", "first").alias("of")))
    out = rows.select("vec_id", "sound", "h1", "h2").join(result.withColumn("sound", F.lit(True)), ["sound", "h1", "h2"], "left")
    component = F.when(F.col("sound"), F.col("of")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))

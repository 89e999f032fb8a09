"""Quality classifier on supervised subword embeddings.

A document is the mean of the learned vectors of its features: its words, its words in pairs with the one before (a pair
of equal words is one feature of its own) and the byte n-grams of its words with their borders, all hashed into one table.
Words and pairs together weigh as much as the n-grams, of which there are many more.
A softmax layer turns the mean into two class probabilities. Table and layer are learned together by minibatch stochastic
gradient descent in numpy, with step sizes per coordinate. As the layer is linear, a learned vector acts on a score through one number, its
share of the logit; scoring gathers those numbers and averages them, and only they (a table of fixed size) are sent to
executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm import rolling
from strata.llm.rows import quoted
from strata.llm.texts import byte_batches

#: UTF-8 bytes of text whose features are made at a time; a longer text is cut at words, and its sums are added up.
PIECE_BYTES = 1 << 19


@dataclass(frozen=True)
class Settings:
    """``sample_rows``: bound on the labelled documents used for fitting (the rows with the smallest hash of their id). Few rows are gone over more
    often than ``epochs`` times, up to ``least_steps`` steps."""

    sample_rows: int = 5000
    buckets_log2: int = 17
    grams: tuple[int, ...] = (3, 4, 5)
    size: int = 8
    epochs: int = 3
    least_steps: int = 400
    batch: int = 32
    rate: float = 0.5
    seed: int = 7


def features(flat: np.ndarray, offsets: np.ndarray, s: Settings, previous: list | None = None):
    """Yields (group, bucket, place): hashed features of words (0) or n-grams (1), and the byte where each begins. ``previous`` holds the hash of
    the word before the first one when a text goes on, and gets that of the last word; it is empty at the beginning of a text."""
    shift = np.uint64(64 - s.buckets_log2)
    begins, ends = rolling.words(flat, offsets)
    if not len(begins):
        return
    hashes = rolling.ranges(rolling.prefix(rolling.TABLE[flat]), begins, ends)
    begins, ends = begins.astype(np.int32), ends.astype(np.int32)
    yield 0, hashes >> shift, begins
    same_doc = np.searchsorted(offsets, begins, side="right")
    paired = np.flatnonzero(same_doc[1:] == same_doc[:-1]) + 1
    left, right, where = hashes[paired - 1], hashes[paired], begins[paired]
    if previous:
        left, right, where = np.insert(left, 0, previous[0]), np.insert(right, 0, hashes[0]), np.insert(where, 0, begins[0])
    if previous is not None:
        previous[:] = [hashes[-1]]
    pairs = np.where(right == left, np.uint64(1), right + left * np.uint64(3))
    yield 0, rolling.mix(pairs) >> shift, where
    # the words' bytes once more, with one blank before each and one at the end
    sizes = ends - begins
    to = np.cumsum(sizes + 1, dtype=np.int32) - sizes
    line = np.full(int(sizes.sum()) + len(sizes) + 1, 0x20, np.uint8)
    inside = np.ones(len(line), bool)
    inside[to - 1] = False
    inside[-1] = False
    whence = np.cumsum(inside, dtype=np.int32)  # a byte of the words, counted over all words
    whence += np.append(np.repeat(begins - to + np.arange(1, len(to) + 1, dtype=np.int32), sizes + 1), np.int32(0)) - 1
    whence[to - 1] = begins
    line[inside] = flat[whence[inside]]
    before = np.zeros(len(line) + 1, np.int32)
    np.cumsum(~inside, dtype=np.int32, out=before[1:])
    wide = line.astype(np.uint32)
    h = wide.copy()
    for n in range(2, max(s.grams) + 1):
        if n > len(line):
            return
        h = h[: len(line) - n + 1] * np.uint32(0x01000193) ^ wide[n - 1 :]
        if n in s.grams:
            at = np.flatnonzero(before[n - 1 : len(line)][: len(h)] == before[1 : len(h) + 1])  # no blank strictly inside
            bucket = (h[at] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            bucket ^= bucket >> np.uint32(15)
            bucket *= np.uint32(0xC2B2AE35)
            yield 1, bucket >> np.uint32(32 - s.buckets_log2), whence[at]


def weighted(flat: np.ndarray, offsets: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the texts as (bucket, text, weight); a text's weights sum to one, half for either group."""
    n, parts = len(offsets) - 1, ([], [])
    for group, bucket, place in features(flat, offsets, s):
        parts[group].append((bucket.astype(np.int64), np.searchsorted(offsets, place, side="right") - 1))
    buckets, docs, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for group in parts:
        doc = np.concatenate([d for _, d in group]) if group else np.zeros(0, np.int64)
        buckets += [b for b, _ in group]
        docs.append(doc)
        weights.append(0.5 / np.maximum(np.bincount(doc, minlength=n), 1)[doc])
    return np.concatenate(buckets), np.concatenate(docs), np.concatenate(weights)


def fit(rows: list[tuple[bytes, int]], s: Settings) -> tuple[np.ndarray, float]:
    """Each bucket's share of the logit of class 1, and the constant. Without rows of both classes the shares are zero and
    the constant is that of the share of class 1 (with one pseudo row each)."""
    table = 1 << s.buckets_log2
    ones = sum(y for _, y in rows)
    prior = math.log((ones + 1) / (len(rows) - ones + 1))
    if not rows or ones in (0, len(rows)):
        return np.zeros(table, np.float32), prior
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.size, 1 / s.size, (table, s.size)).astype(np.float32)
    layer = np.zeros((s.size, 2), np.float64)
    bias = np.array([0.0, prior])
    seen_vectors = np.full((table, s.size), 1e-8, np.float32)
    seen_layer, seen_bias = np.full(layer.shape, 1e-8), np.full(2, 1e-8)
    for _ in range(max(s.epochs, -(-s.least_steps * s.batch // len(rows)))):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), s.batch):
            some = [rows[i] for i in order[k : k + s.batch]]
            flat = np.frombuffer(b"".join(t for t, _ in some), np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(t) for t, _ in some])))
            n = len(some)
            bucket, doc, weight = weighted(flat, offsets, s)
            mean = np.stack([np.bincount(doc, weights=vectors[bucket, j] * weight, minlength=n) for j in range(s.size)], axis=1)
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), [y for _, y in some]] -= 1
            slope = p / n
            back = slope @ layer.T
            g_layer, g_bias = mean.T @ slope, slope.sum(axis=0)
            for j in range(s.size):
                g = np.bincount(bucket, weights=back[doc, j] * weight, minlength=table).astype(np.float32)
                seen_vectors[:, j] += g * g
                vectors[:, j] -= s.rate * g / np.sqrt(seen_vectors[:, j])
            seen_layer += g_layer**2
            layer -= s.rate * g_layer / np.sqrt(seen_layer)
            seen_bias += g_bias**2
            bias -= s.rate * g_bias / np.sqrt(seen_bias)
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", s: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Fits on at most ``s.sample_rows`` labelled documents, whole texts, in one task; the model is a table of fixed size.
    ``labels`` (doc_id, label): null ids and labels other than 0 and 1 are ignored; an id with both labels counts as 1;
    ids without a document don't count. Of several documents with one id the smallest text is taken; null is empty."""
    one = (labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max(label_col).cast("int").alias("y")))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id")  # at most sample_rows ids
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))

    def run(batches):
        found = [(i, t.encode(), y) for b in batches for i, t, y in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        shares, constant = fit([x[1:] for x in sorted(found, key=lambda x: str(x[0]))], s)
        yield pa.RecordBatch.from_pydict({"shares": pa.array([shares.tobytes()], pa.binary()), "constant": [constant]})

    model = rows.repartition(1).mapInArrow(run, "shares binary, constant double").first()
    if model is None:  # no labelled document, no task
        return fit([], s)
    return np.frombuffer(model.shares, np.float32), model.constant


def word_parts(flat: np.ndarray, most: int):
    """(begin, end) of parts of a text of about ``most`` bytes, cut at white space; a longer word is not cut."""
    begin, n = 0, len(flat)
    while begin < n:
        end = min(begin + most, n)
        while end < n:
            blank = np.flatnonzero(rolling.spaces(flat[end : end + most]))
            if len(blank):
                end += int(blank[0])
                break
            end = min(end + most, n)
        yield begin, end
        begin = end


def logits(flat: np.ndarray, offsets: np.ndarray, shares: np.ndarray, s: Settings, most: int = PIECE_BYTES) -> np.ndarray:
    """Mean share of the features of each text, half for either group; 0 without words."""
    n = len(offsets) - 1
    total, count = np.zeros((2, n)), np.zeros((2, n), np.int64)

    def add(part, cuts_at, to, previous=None):
        for group, bucket, place in features(part, cuts_at, s, previous):
            cuts = np.searchsorted(place, cuts_at)
            sums = np.concatenate(([0.0], np.cumsum(shares[bucket], dtype=np.float64)))
            total[group, to] += sums[cuts[1:]] - sums[cuts[:-1]]
            count[group, to] += np.diff(cuts)

    if n == 1 and len(flat) > most:
        previous: list = []
        for a, b in word_parts(flat, most):
            add(flat[a:b], np.array([0, b - a]), slice(0, 1), previous)
    else:
        add(flat, offsets, slice(0, n))
    return 0.5 * (total / np.maximum(count, 1)).sum(axis=0)


def score(docs: DataFrame, model: tuple[np.ndarray, float], s: Settings = Settings(), text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Adds ``score_col``: the probability of class 1 of the whole text. A text without words (null, empty, blank) has the
    score of the constant alone. Other columns are kept, whatever their names; an earlier ``score_col`` is replaced. No shuffle; each text goes to
    the worker once. A task holds a batch of rows, and the features of about ``PIECE_BYTES`` of text or of one longer word."""
    keep = [c for c in docs.columns if c != score_col]
    numbered = [F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate(keep)]
    text = f"c{keep.index(text_col)}" if text_col in keep else "t"
    rows = docs.select(*numbered, *([] if text_col in keep else [F.col(quoted(text_col)).alias("t")]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        shares, constant = shared.value
        for part, flat, offsets in byte_batches(batches, text, PIECE_BYTES):
            value = 1 / (1 + np.exp(-(logits(flat, offsets, shares, s) + constant)))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(value)], names=[*(f"c{k}" for k in range(len(keep))), "s"])

    scored = rows.mapInArrow(run, rows.select(*[f"c{k}" for k in range(len(keep))]).schema.add("s", "double"))
    return scored.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(keep)], F.col("s").alias(score_col))

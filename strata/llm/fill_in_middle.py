"""Fill-in-the-middle: a text is cut into prefix, middle and suffix, which are put in another order between sentinels.

Cuts are drawn in units of a text (words and single characters, or code points), texts are cut in bytes, and lengths are told in code
points. A **sparse exception index** takes one to the other: only multibyte characters are recorded, each with its byte, its code point and
the bytes that all before it have beyond one. A binary search among them (``searchsorted``) gives the excess at a cut; between two of them,
in ASCII, code points and bytes go in step and the rest is an addition. A text in ASCII has an empty index.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.rows import others, packed, quoted, unpacked
from strata.llm.texts import byte_batches

#: UTF-8 bytes of text handled at a time.
PIECE_BYTES = 1 << 20
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


class ExceptionIndex:
    """The multibyte characters of UTF-8 bytes: where code points and bytes part."""

    def __init__(self, flat: np.ndarray):
        self.byte = np.flatnonzero(flat >= 0xC0)  # first bytes of multibyte characters
        first = flat[self.byte]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(excess)))  # in all characters before the k-th exception
        self.point = self.byte - self.excess[:-1]

    def points(self, byte):
        """Code points before a byte that begins a character (or ends the bytes)."""
        return byte - self.excess[np.searchsorted(self.byte, byte)]

    def bytes(self, point):
        """Bytes before a code point."""
        return point + self.excess[np.searchsorted(self.point, point)]


@dataclass(frozen=True)
class Settings:
    """``sentinels`` stand before prefix, suffix and middle. Of 100 texts ``plain`` stay as they are, of the others ``spm`` get the suffix
    first. ``unit``: cuts fall between "words" (runs of A-Z and a-z; any other character is a unit by itself) or "chars"."""

    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    plain: int = 10
    spm: int = 20
    unit: str = "words"
    seed: int = 1

    def __post_init__(self):
        for s in self.sentinels:
            for t in self.sentinels:
                if not s or (s is not t and s in t) or any(s[-k:] == t[:k] for k in range(1, min(len(s), len(t)))):
                    raise ValueError("sentinels must be non-empty, none may hold another or begin as one ends: outputs could not be read back")
        if len(set(self.sentinels)) < 3 or self.unit not in ("words", "chars"):
            raise ValueError("three different sentinels and the unit words or chars are needed")


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers from 0 to 2**32 - 1 for a document; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def unit_starts(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the units of texts in a row: ASCII letters in a run are one, each other character is one."""
    letter = ((flat | 0x20) - np.uint8(0x61)) < 26
    inner = np.zeros(len(flat) + 1, bool)
    inner[1:-1] = letter[1:] & letter[:-1]
    inner[offsets] = False  # no run crosses texts
    return np.flatnonzero(~inner[:-1] & ((flat & 0xC0) != 0x80))


def transform_piece(ids: list, flat: np.ndarray, offsets: np.ndarray, s: Settings) -> list[tuple]:
    """(n, form, prefix_chars, middle_chars, output as bytes) of each text."""
    index = ExceptionIndex(flat)
    begin_point = index.points(offsets)
    if s.unit == "words":
        starts = np.append(unit_starts(flat, offsets), len(flat))
        first = np.searchsorted(starts[:-1], offsets)
    else:
        first = begin_point
    counts = np.diff(first)
    drawn = np.array([draws(i, s.seed) for i in ids], np.int64).reshape(-1, 4)
    ends = np.sort(drawn[:, :2] % (counts + 1)[:, None], axis=1) + first[:-1, None]  # units before the cuts, from the piece's first
    if s.unit == "words":
        cuts = starts[ends]
        cuts = np.where(ends >= first[1:, None], offsets[1:, None], cuts)
    else:
        cuts = index.bytes(ends)
    points = index.points(cuts)
    data = flat.tobytes()
    p, f, m = (x.encode() for x in s.sentinels)
    out = []
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        text, n = data[a:b], int(counts[k])
        if not text or drawn[k, 2] % 100 >= 100 - s.plain or any(x in text for x in (p, f, m)):
            out.append((n, "plain", None, None, text))
            continue
        c, d = cuts[k].tolist()
        prefix, middle, suffix = data[a:c], data[c:d], data[d:b]
        spm = drawn[k, 3] % 100 < s.spm
        whole = b"".join((f, suffix, p, prefix, m, middle) if spm else (p, prefix, f, suffix, m, middle))
        out.append((n, "spm" if spm else "psm", int(points[k, 0] - begin_point[k]), int(points[k, 1] - points[k, 0]), whole))
    return out


def transform(docs: DataFrame, s: Settings = Settings(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row, all columns but the text, and n (units of the text, long), form ("plain", "psm": prefix, suffix, middle, or "spm":
    suffix, prefix, middle), prefix_chars and middle_chars (code points; null if plain) and output. A text is plain if it is
    empty (null: empty), holds a sentinel, or is drawn to be. What is drawn depends on the id alone (a null id is an empty one; rows of
    one id draw alike). Earlier columns with a result's name are replaced. No shuffle; a task holds a piece of ``PIECE_BYTES`` or
    one longer text."""
    keep = others(docs, text_col, *RESULTS)
    rows = docs.select(packed(keep), F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("t"))
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64())

    def run(batches):
        for part, flat, offsets in byte_batches(batches, "t", PIECE_BYTES):
            made = transform_piece(part.column(1).to_pylist(), flat, offsets, s)
            columns = [pa.array([x[k] for x in made], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array([x[4] for x in made], pa.binary()).cast(pa.string())],
                                             names=["row", *RESULTS])

    schema = rows.select("row").schema.add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")
    return rows.mapInArrow(run, schema).select(*unpacked(keep), *RESULTS)


def restored(output: Column, form: Column, s: Settings = Settings()) -> Column:
    """The text that ``transform`` made the output from. Each sentinel stands in it once: texts with one are plain."""
    p, f, m = s.sentinels
    head = lambda mark, until: F.substr(F.substring_index(output, until, 1), F.lit(len(mark) + 1))
    inner = lambda mark, until: F.substring_index(F.substring_index(output, mark, -1), until, 1)
    middle = F.substring_index(output, m, -1)
    return (F.when(form == "psm", F.concat(head(p, f), middle, inner(f, m)))
            .when(form == "spm", F.concat(inner(p, m), middle, head(f, p))).otherwise(output))

"""Quality rules on repetition coverage.

Words are runs without ASCII white space. Words and lines get numbers from an Arrow dictionary, so they are told apart by their bytes. Hashes of word
n-grams of several lengths roll over prefix sums of numbers drawn for the words, in numpy: n-grams of ten words at most, so two different ones have one hash
by chance only (2**-64). An n-gram found twice or more in a text covers its words, and a rule compares the characters (code points) in covered
words, or in repeated lines, with those of all words. Longer n-grams are looked for only where the shorter ones repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm import rolling
from strata.llm.rows import others, packed, quoted, unpacked
from strata.llm.texts import byte_batches

#: UTF-8 bytes of text measured at a time; a longer text is measured whole.
PIECE_BYTES = 1 << 20

#: Largest share of word characters inside later occurrences of n-grams, by n. Over what the 3,409 documents labelled good of the 10,000 at sf0.1
#: show (0.14 for 5 to 8 words, a refrain, and 0.09 for 10), and falling with n: a long n-gram is repeated by chance least.
GRAM_LIMITS = {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.14, 10: 0.12}
#: Largest share of word characters inside lines that equal an earlier line.
LINE_LIMIT = 0.20
SYMBOLS = b"#*$%&|<>"
BASE_GRAM = 8


def numbers(flat: np.ndarray, inside: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Equal numbers for equal strings: those of ``sizes`` bytes that follow each other in the bytes marked ``inside``."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    strings = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat[inside]))])
    return strings.dictionary_encode().indices.to_numpy().astype(np.int64)


def repeated(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows share their key with another row of the same text, and which of them with an earlier one."""
    both = rolling.mix(keys ^ rolling.mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    later = np.zeros(len(keys), bool)
    later[order[1:]] = same
    out = later.copy()
    out[order[:-1]] |= same
    return out, later


def covered(where: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in windows of ``size`` words that begin at ``where``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, where, 1)
    np.add.at(change, where + size, -1)
    return np.cumsum(change)[:-1] > 0


def measure(flat: np.ndarray, offsets: np.ndarray, grams=tuple(GRAM_LIMITS)) -> dict[str, np.ndarray]:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, and for n-grams found twice or
    more dup_{n}_chars (characters in all occurrences) and later_{n}_chars (in all but the first)."""
    n = len(offsets) - 1
    begins, ends = rolling.words(flat, offsets)
    text = np.searchsorted(offsets, begins, side="right") - 1
    count = lambda of, w=None: np.bincount(of, weights=w, minlength=n).astype(np.int64)
    points = np.concatenate(([0], np.cumsum((flat & 0xC0) != 0x80)))
    chars = points[ends] - points[begins]
    in_words = np.concatenate(([0], np.cumsum(~rolling.spaces(flat))))
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    symbols = np.concatenate(([0], np.cumsum(is_symbol[flat])))
    out = {"n_words": count(text), "word_chars": count(text, chars), "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]]}

    breaks = flat == 0x0A
    line_begin = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(breaks) + 1)))
    line_begin = line_begin[line_begin < len(flat)]
    line_text = np.searchsorted(offsets, line_begin, side="right") - 1
    line_end = np.minimum(np.append(line_begin[1:], len(flat)), offsets[line_text + 1])
    line_end = line_end - ((line_end > line_begin) & breaks[np.maximum(line_end, 1) - 1])
    line = numbers(flat, ~breaks, line_end - line_begin)
    full = np.flatnonzero(in_words[line_end] > in_words[line_begin])
    line_begin, line_end, line_text, line = line_begin[full], line_end[full], line_text[full], line[full]
    order = np.lexsort((line, line_text))  # equal lines in order of place
    again = order[1:][(line[order][1:] == line[order][:-1]) & (line_text[order][1:] == line_text[order][:-1])]
    word_chars = np.concatenate(([0], np.cumsum(np.where(rolling.spaces(flat), 0, (flat & 0xC0) != 0x80))))
    out["n_dup_lines"] = count(line_text[again])
    out["dup_line_chars"] = count(line_text[again], (word_chars[line_end] - word_chars[line_begin])[again])

    drawn = rolling.mix(numbers(flat, ~rolling.spaces(flat), ends - begins).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    hashes = rolling.prefix(drawn)
    where = np.arange(len(begins))
    for size in sorted({*grams, BASE_GRAM}):
        where = where[where + size <= len(begins)]
        where = where[text[where] == text[where + size - 1]]
        twice, later = repeated(rolling.ranges(hashes, where, where + size), text[where])
        again = covered(where[later], size, len(begins))
        out[f"later_{size}_chars"] = count(text[again], chars[again])
        where = where[twice]
        both = covered(where, size, len(begins))
        out[f"dup_{size}_chars"] = count(text[both], chars[both])
        if size == BASE_GRAM:
            out["n_repeat_words"] = count(text[both])
    return out


def rules(docs: DataFrame, text_col: str = "text", gram_limits: dict[int, float] = GRAM_LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """Per row, without its text: the measures of ``measure``, ``base_failed`` (under 20 words, or over 30 of 100 words in
    repeated 8-word windows) and ``kept``: not base_failed and no share of characters over its limit. A text without words
    (null, empty, blank) fails the base. Other columns are kept unless a measure has their name. No shuffle."""
    grams = tuple(sorted(gram_limits))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
    names += [f"{kind}_{n}_chars" for n in sorted({*grams, BASE_GRAM}) for kind in ("dup", "later")]
    keep = others(docs, *names, "base_failed", "kept", text_col)
    rows = docs.select(packed(keep), F.col(quoted(text_col)).alias("t"))

    def run(batches):
        for part, flat, offsets in byte_batches(batches, "t", PIECE_BYTES):
            got = measure(flat, offsets, grams)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(got[k], pa.int64()) for k in names)], names=["row", *names])

    schema = rows.select("row").schema
    for name in names:
        schema = schema.add(name, "long")
    out = rows.mapInArrow(run, schema).select(*unpacked(keep), *names)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    over = F.col("dup_line_chars") > line_limit * F.col("word_chars")
    for n, most in gram_limits.items():
        over |= F.col(f"later_{n}_chars") > most * F.col("word_chars")
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)

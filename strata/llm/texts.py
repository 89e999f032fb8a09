"""Arrow batches of texts in bounded pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: UTF-8 bytes of text handled at a time; a longer single text makes a piece of its own.
PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``most`` bytes together; at least one row each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def text_batches(batches, column: str, most: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Pieces with their texts as Python strings; a null text is the empty one."""
    for batch in batches:
        for part in pieces(batch, column, most):
            yield part, [x or "" for x in part.column(column).to_pylist()]


def byte_batches(batches, column: str, most: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces with all their UTF-8 bytes in one array and the n + 1 offsets of the texts in it (null: empty)."""
    for batch in batches:
        for part in pieces(batch, column, most):
            texts = pc.fill_null(part.column(column), "").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = texts.buffers()[2]
            flat = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
            yield part, flat, offsets - offsets[0]


def grouped(batches, keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of equal first ``keys`` columns, as tables, from batches in which a group's rows follow each other."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in range(keys):
            column = batch.column(k)
            if batch.num_rows > 1:
                differs = pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1))
                change[1:] |= pc.fill_null(differs, True).to_numpy(zero_copy_only=False)
        cuts = [*np.flatnonzero(change).tolist(), batch.num_rows]
        begin = 0
        for end in cuts:
            key = tuple(batch.column(k)[begin].as_py() for k in range(keys))
            if held and key != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(begin, end - begin))
            begin = end
    if held:
        yield current, pa.Table.from_batches(held)

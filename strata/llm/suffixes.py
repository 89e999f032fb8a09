"""Removal of byte strings that occur more than once, by suffix arrays built with two-stage sorting.

**Which suffixes meet.** Two equal strings of ``length`` bytes contain the same ``gram``-byte strings, so both choose the same
*anchor*: the gram with the smallest hash in the window. Windows of one document with one anchor are neighbours; they make a
*segment* (the windows' bytes, under 2 * length). Only segments whose anchor gram occurs elsewhere can hold a repeat, and a repeat of
a window lies in the same anchor's group. Equal segments are counted before any shuffle and stand for all their copies.

**Copies.** Texts that occur more than once are found first, by hashes of whole texts. All copies of one that is long enough are removed whole; one of
them goes on, to be met by other texts, so thousands of copies cost as much as one.

**Suffix arrays.** The different segments of a group go to one task, many groups to a task. There the suffixes that are smaller
than their successors are sorted directly; scanning the buckets (first byte) upwards induces the others: each stands behind the
smaller successor it extends, so a bucket's induced part follows the order of successors already placed, runs of one byte level by
level. The common prefix of neighbours in the array, counted up to ``length``, tells which windows occur twice.

A group with over ``group_segments`` different segments (the edges of a passage found everywhere) would be too much for a task.
Its segments are cut into pieces of a few windows at the same distances from the anchor, and pieces are grouped by their core, the
bytes that all of a piece's windows contain: windows can only be equal if the cores are. Equal pieces are one again. Groups that are still
too large are cut finer; a piece of one window is its own core, so its group holds one text and needs no sorting.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm import rolling
from strata.llm.rows import others, packed, quoted, unpacked
from strata.llm.store import kept
from strata.llm.texts import byte_batches

#: UTF-8 bytes whose segments are looked for at a time; a longer text is gone through in parts of this many windows.
PIECE_BYTES = 1 << 20
#: Repeated texts (two hashes each) that are sent to every task; more of them are joined by shuffle.
MOST_SENT = 200_000

#: A segment is known by a gram of this part of the length sought: shorter ones make longer, so fewer, segments; longer ones
#: are rarer, so they bring fewer different segments together.
GRAM_PART = 8
#: Different segments of one group that are sorted in one task.
GROUP_SEGMENTS = 2000
#: Windows of a piece when a group is too large, and when its pieces' groups still are.
PIECE_WINDOWS = (64, 8, 1)
_PLACE = 24  # bits of an anchor's place in a piece: pieces are shorter than 2**24 bytes


def segments(flat: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, begin, windows, anchor - begin, gram hash, segment hash) of the texts' segments, as arrays; begin counts from
    the text's first byte."""
    n, span = len(flat), length - gram + 1
    windows = n - length + 1
    if windows <= 0:
        return None
    sums = rolling.prefix(rolling.TABLE[flat])
    inverse = rolling.powers(rolling.INVERSE, n + 1)
    count = n - gram + 1
    hashes = rolling.mix((sums[gram:] - sums[:-gram]) * inverse[:count])
    if n >> _PLACE:
        raise ValueError("the piece is too long")  # an anchor must not depend on the length of the piece
    low = np.uint64((1 << _PLACE) - 1)
    blocks = -(-count // span)
    key = np.full(blocks * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    key[:count] = (hashes & ~low) | np.arange(count, dtype=np.uint64)  # equal hashes: the first one
    key = key.reshape(blocks, span)
    left = np.minimum.accumulate(key, axis=1).ravel()
    right = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(right[:windows], left[span - 1 : span - 1 + windows]) & low).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    at = np.flatnonzero(np.arange(windows) + length <= offsets[text + 1])
    if not len(at):
        return None
    of = anchor[at]
    first = np.concatenate(([True], (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])))
    begin = at[first]
    last = at[np.append(first[1:], True)]
    a = of[first]
    whole = rolling.mix(rolling.ranges(sums, begin, last + length) ^ rolling.mix((a - begin).astype(np.uint64)))
    return text[begin], begin - offsets[text[begin]], last - begin + 1, a - begin, hashes[a], whole


def suffix_array(data: np.ndarray, begins: np.ndarray, owned: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes at ``begins[i] + 0 .. owned[i] - 1`` of the segments that end at ``ends[i]``; suffixes whose first
    ``depth`` bytes are equal stand together."""
    n = len(data)
    raw = data.tobytes()
    wide = data.astype(np.int16)
    last = np.zeros(n, bool)
    last[ends - 1] = True
    change = np.where(last, -1, np.append(np.sign(wide[1:] - wide[:-1]), -1))  # a segment's end is smaller than all
    settles = np.where(change != 0, np.arange(n), n)
    settles = np.minimum.accumulate(settles[::-1])[::-1]
    rises = change[settles] > 0  # smaller than its successor
    # up to the first rising suffix behind a segment's own ones, from which they are induced; else to its end
    next_rise = np.minimum.accumulate(np.where(rises, np.arange(n), n)[::-1])[::-1]
    stop = np.minimum(np.append(next_rise, n)[begins + owned], ends)
    sizes = stop - begins + (stop < ends)
    place = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    end_of = np.repeat(ends, sizes)
    direct = np.flatnonzero(rises[place])
    parts = [raw[p:e] for p, e in zip(place[direct].tolist(), np.minimum(place[direct] + depth, end_of[direct]).tolist())]
    direct = direct[sorted(range(len(parts)), key=parts.__getitem__)] if parts else direct
    del parts
    rank = np.zeros(n + 1, np.int64)  # by place; 0: the end of a segment
    induced = place[~rises[place]]
    level = settles[induced] - induced  # steps to the end of the run of one byte
    order = np.lexsort((level, wide[induced]))
    induced, level = induced[order], level[order]
    sorted_direct = place[direct]
    byte_i, byte_d = data[induced], data[sorted_direct]
    cuts = np.flatnonzero((np.diff(byte_i.astype(np.int16)) != 0) | (np.diff(level) != 0)) + 1
    groups = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(induced)])) if len(induced) else []
    after = 1
    done = []
    k = 0
    for c in np.unique(np.concatenate((byte_i, byte_d))).tolist():
        while k < len(groups) and byte_i[groups[k][0]] == c:
            some = induced[groups[k][0] : groups[k][1]]
            before = np.where(last[some], 0, rank[some + 1])
            some = some[np.argsort(before, kind="stable")]
            rank[some] = np.arange(after, after + len(some))
            after += len(some)
            done.append(some)
            k += 1
        a, b = np.searchsorted(byte_d, [c, c + 1]) if len(byte_d) else (0, 0)
        some = sorted_direct[a:b]
        rank[some] = np.arange(after, after + len(some))
        after += len(some)
        done.append(some)
    array = np.concatenate(done) if done else np.zeros(0, np.int64)
    own = np.zeros(n, bool)
    own_size = owned
    own[np.repeat(begins - (np.cumsum(own_size) - own_size), own_size) + np.arange(own_size.sum())] = True
    return array[own[array]]


def adjacent_prefixes(data: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """Whole 8-byte steps of the common prefix of neighbours in the array, in bytes, up to ``most`` (a last shorter step included)."""
    out = np.zeros(max(0, len(array) - 1), np.int64)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.ndarray(len(data), dtype="<u8", buffer=padded.tobytes(), strides=(1,))
    pair = np.arange(len(out))
    for at in range(0, most, 8):
        left, right = words[array[pair] + at], words[array[pair + 1] + at]
        diff = left ^ right
        if most - at < 8:
            diff &= np.uint64((1 << 8 * (most - at)) - 1)
        pair = pair[diff == 0]
        out[pair] = min(at + 8, most)
    return out


def repeated_runs(parts: list[bytes], windows: np.ndarray, many: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For every segment the runs (from, to) of windows that occur elsewhere. ``many``: segments that occur more than once."""
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = np.frombuffer(b"".join(parts), np.uint8)
    array = suffix_array(data, begins, windows, ends, length)
    same = adjacent_prefixes(data, array, length) >= length
    hit = np.zeros(len(data) + 1, bool)
    hit[array[1:][same]] = True
    hit[array[:-1][same]] = True
    for k in np.flatnonzero(many):
        hit[begins[k] : begins[k] + windows[k]] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit)).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    # a run of hits never leaves its segment: its last length - 1 bytes begin no window
    of = np.searchsorted(ends, starts, side="right")
    out: list[list[tuple[int, int]]] = [[] for _ in parts]
    for k, a, b in zip(of.tolist(), starts.tolist(), stops.tolist()):
        out[k].append((a - int(begins[k]), b - int(begins[k])))
    return out


def text_parts(flat: np.ndarray, offsets: np.ndarray, length: int, most: int):
    """(first text, first byte in it, bytes, offsets) of parts: many texts, or the bytes of ``most`` windows of one that is longer."""
    if len(flat) <= 2 * most:
        yield 0, 0, flat, offsets
        return
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for begin in range(a, max(b - length + 1, a), most):
            end = min(begin + most + length - 1, b)
            yield k, begin - a, flat[begin:end], np.array([0, end - begin])


def spans(once: DataFrame, length: int = 400, gram: int | None = None, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """(k1, k2, spans): byte ranges (begin, end) of texts that are covered by repeated strings of ``length`` bytes, possibly
    overlapping; a row per text that has any, texts with ``again`` left out. ``once``: different texts, as (k1, k2, again, t): two hashes of the
    text, whether there are copies of it, and its bytes, ``length`` at least."""
    gram = gram or max(1, length // GRAM_PART)

    def cut(batches):
        """One row per different segment of a piece, with all places where the piece has it: near copies that lie together are a row each segment."""
        for part, flat, offsets in byte_batches(batches, "t", PIECE_BYTES):
            for first, base, some, cuts in text_parts(flat, offsets, length, PIECE_BYTES):
                got = segments(some, cuts, length, gram)
                if got is None:
                    continue
                row, begin, windows, anchor, g, whole = got
                order = np.lexsort((whole, g))
                g, whole, row, begin = g[order], whole[order], row[order] + first, begin[order] + base
                new = np.concatenate(([True], (g[1:] != g[:-1]) | (whole[1:] != whole[:-1])))
                cuts_at = np.append(np.flatnonzero(new), len(g))
                again = part.column(2).take(pa.array(row))
                n = np.add.reduceat(1 + again.to_numpy(zero_copy_only=False).astype(np.int64), cuts_at[:-1])
                # a piece is known by its first text and byte: the same if the task is run again
                piece = int(rolling.mix(np.uint64([part.column(0)[first].as_py() % (1 << 64)]) + rolling.mix(np.uint64([base])))[0].view(np.int64))
                places = pa.StructArray.from_arrays([part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(begin, pa.int32()), again],
                                                    names=["k1", "k2", "begin", "again"])
                one = order[cuts_at[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(one), piece)), pa.array(g[new].view(np.int64)), pa.array(whole[new].view(np.int64)), pa.array(n), pa.array(windows[one], pa.int32()),
                     pa.array(anchor[one], pa.int32()), pa.ListArray.from_arrays(pa.array(cuts_at, pa.int32()), places)],
                    names=["piece", "gram", "whole", "n", "windows", "anchor", "places"])

    every = kept(once.select("k1", "k2", "again", "t").mapInArrow(
        cut, "piece long, gram long, whole long, n long, windows int, anchor int, places array<struct<k1:long,k2:long,begin:int,again:boolean>>"), "suffix_segments")
    # one row per different segment, then what its group holds; a segment of a text with copies occurs more than once. The sides of joins on
    # ``gram`` are stored tables, so the joins are of plain shuffles, which adaptive execution splits where a gram is hot
    grams = kept(every.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"), "suffix_grams")
    place = F.struct(F.col("places")[0]["k1"].alias("k1"), F.col("places")[0]["k2"].alias("k2"), F.col("places")[0]["begin"].alias("begin"), "windows", "anchor")
    one = every.groupBy("gram", "whole").agg(F.sum("n").alias("times"), F.min(place).alias("at"))
    one = kept(one.join(grams, "gram"), "suffix_classes")
    sizes = kept(one.groupBy("gram").agg(F.count("*").alias("different")), "suffix_sizes")
    whole = one.join(sizes.where("different = 1"), "gram").where("times > 1").select(
        "gram", "whole", F.array(F.struct(F.lit(0).alias("from"), F.col("at.windows").alias("to"))).alias("runs"))
    wanted = one.join(sizes.where("different > 1"), "gram")
    wanted = wanted.select("at.k1", "at.k2", F.struct("gram", "whole", "times", "at.begin", "at.windows", "at.anchor").alias("s"))
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_list("s").alias("wanted"))  # at most a text's segments

    def fetch(batches):
        for batch in batches:
            out = []
            for text, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = (text or "").encode()
                out += [{k: s[k] for k in ("gram", "whole", "times", "windows", "anchor")}
                        | {"part": data[s["begin"] : s["begin"] + s["windows"] + length - 1]} for s in some]
            yield pa.RecordBatch.from_pylist(out, schema=PARTS)

    parts = kept(once.join(wanted, ["k1", "k2"]).select("t", "wanted").mapInArrow(fetch, PARTS_DDL), "suffix_parts")
    runs = kept(whole.union(repeats(parts, length, group_segments, PIECE_WINDOWS)), "suffix_runs")

    def gather(batches):
        for batch in batches:
            for found in batch.column(0):
                yield piece_spans(found.values, length)

    # the runs go to all places in a piece together, then to its texts: a row each, however many segments it has
    mine = every.select("piece", "gram", "whole", F.filter("places", lambda x: ~x["again"]).alias("places")).where(F.size("places") > 0)
    mine = mine.join(runs, ["gram", "whole"]).groupBy("piece").agg(F.collect_list(F.struct("places", "runs")).alias("found"))  # at most a piece's segments
    mine = mine.select("found").mapInArrow(gather, "k1 long, k2 long, spans array<struct<begin:int,end:int>>")
    return mine.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # a long text comes from several pieces


def piece_spans(found: pa.StructArray, length: int) -> pa.RecordBatch:
    """(k1, k2, spans) per text of a piece: the byte ranges that its runs of windows cover, joined where they meet. ``found``: for each segment its places and
    the runs, counted from where the segment begins."""
    places, runs = found.field("places"), found.field("runs")
    at, run = places.flatten(), runs.flatten()
    count = np.diff(runs.offsets.to_numpy())
    of = np.repeat(np.arange(len(found)), np.diff(places.offsets.to_numpy()))
    times = count[of]  # each place has all runs of its segment
    which = np.repeat((np.cumsum(count) - count)[of] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    k1, k2, begin = (np.repeat(at.field(c).to_numpy(), times) for c in ("k1", "k2", "begin"))
    begin = begin.astype(np.int64)
    end = begin + run.field("to").to_numpy()[which] + (length - 1)
    begin = begin + run.field("from").to_numpy()[which]
    order = np.lexsort((begin, k2, k1))
    k1, k2, begin, end = k1[order], k2[order], begin[order], end[order]
    text = np.cumsum(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))))
    reach = np.maximum.accumulate((text << 32) + end)  # a text's ranges never reach into the next text's
    new = np.concatenate(([True], (text[1:] << 32) + begin[1:] > reach[:-1]))
    last = np.append(np.flatnonzero(new)[1:], len(text)) - 1
    text, k1, k2, begin, end = text[new], k1[new], k2[new], begin[new], reach[last] & 0xFFFFFFFF
    first = np.flatnonzero(np.diff(text, prepend=0))
    spans = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(end, pa.int32())], names=["begin", "end"])
    return pa.RecordBatch.from_arrays([pa.array(k1[first]), pa.array(k2[first]), pa.ListArray.from_arrays(pa.array(np.append(first, len(text)), pa.int32()), spans)],
                                      names=["k1", "k2", "spans"])


PARTS = pa.schema([("gram", pa.int64()), ("whole", pa.int64()), ("times", pa.int64()), ("windows", pa.int32()), ("anchor", pa.int32()),
                   ("part", pa.binary())])
RUNS = pa.schema([("gram", pa.int64()), ("whole", pa.int64()), ("runs", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))])
PARTS_DDL = "gram long, whole long, times long, windows int, anchor int, part binary"


def repeats(parts: DataFrame, length: int, group_segments: int, steps: tuple[int, ...]) -> DataFrame:
    """(gram, whole, runs): runs (from, to) of windows that occur more than once, for segments that have any. ``parts``: one row per different segment (gram, whole), with the times it
    occurs, its windows, its anchor's place and its bytes."""
    sizes = kept(parts.groupBy("gram").agg(F.count("*").alias("different")), "suffix_sizes")

    def sort(batches):
        def runs(rows):
            found = repeated_runs([r[4] for r in rows], np.array([r[3] for r in rows], np.int64), np.array([r[2] > 1 for r in rows]), length)
            some = [{"gram": r[0], "whole": r[1], "runs": [{"from": a, "to": b} for a, b in f]} for r, f in zip(rows, found) if f]
            return pa.RecordBatch.from_pylist(some, schema=RUNS)

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "whole", "times", "windows", "part"))):
                if len(held) >= group_segments and held[-1][0] != row[0]:
                    yield runs(held)
                    held = []
                held.append(row)
        if held:
            yield runs(held)

    width = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = (parts.join(sizes.where(F.col("different") <= group_segments), "gram").select("gram", "whole", "times", "windows", "part")
             .repartition(width, "gram").sortWithinPartitions("gram", "whole"))
    found = small.mapInArrow(sort, "gram long, whole long, runs array<struct<from:int,to:int>>")
    large = sizes.where(F.col("different") > group_segments)
    if large.isEmpty():
        return found
    if not steps:
        raise ValueError("the last step has to be pieces of one window, whose groups hold one text")
    step = steps[0]

    def cut(batches):
        for batch in batches:
            out = []
            for gram, whole, times, windows, anchor, part in zip(*(c.to_pylist() for c in batch.columns)):
                for number in range(-anchor // step, (windows - 1 - anchor) // step + 1):  # windows number * step .. + step - 1 from the anchor
                    first, last = max(0, number * step + anchor), min(windows, number * step + step + anchor) - 1
                    piece = part[first : last + length]
                    core = part[number * step + step - 1 + anchor : number * step + anchor + length]
                    of = hashlib.md5(b"%d %d " % (gram, number) + core).digest()
                    out.append({"gram": int.from_bytes(of[:8], "little", signed=True),
                                "whole": int.from_bytes(hashlib.md5(b"%d " % (first - anchor) + piece).digest()[:8], "little", signed=True),
                                "times": times, "windows": last - first + 1, "anchor": anchor - first, "part": piece,
                                "from_gram": gram, "from_whole": whole, "first": first})
            yield pa.RecordBatch.from_pylist(out, schema=pieces_schema)

    pieces_schema = pa.schema([*PARTS, ("from_gram", pa.int64()), ("from_whole", pa.int64()), ("first", pa.int32())])
    pieces = kept(parts.join(large, "gram").select(*PARTS.names).mapInArrow(
        cut, f"{PARTS_DDL}, from_gram long, from_whole long, first int"), "suffix_pieces")
    classes = kept(pieces.groupBy("gram", "whole").agg(F.sum("times").alias("times"), *[F.first(c).alias(c) for c in ("windows", "anchor", "part")]), "suffix_parts")
    finer = kept(repeats(classes, length, group_segments, steps[1:]), "suffix_runs")
    moved = F.transform("runs", lambda r: F.struct((r["from"] + F.col("first")).alias("from"), (r["to"] + F.col("first")).alias("to")))
    back = pieces.select("gram", "whole", "from_gram", "from_whole", "first").join(finer, ["gram", "whole"]).select(
        "from_gram", "from_whole", moved.alias("runs"))
    back = back.groupBy("from_gram", "from_whole").agg(F.flatten(F.collect_list("runs")).alias("runs"))  # at most a segment's windows
    return found.union(back)


def remove_repeats(docs: DataFrame, length: int = 400, text_col: str = "text", id_col: str | None = None, **how) -> DataFrame:
    """All columns of ``docs`` with ``text_col`` replaced by what is left, and n_bytes, n_removed, n_spans (maximal removed runs)
    and kept_sha256 (of the remaining bytes). Removed is each byte covered by a ``length``-byte string that also starts anywhere
    else in the table, in the same text too (matches may overlap, none crosses texts); strings are judged on the input. A character cut by a removal
    leaves the text; the digest is of the bytes. A null text is empty. Columns named like a result are replaced, others may have any name.
    Repeated rows are copies of each other; ids are not needed (``id_col`` is accepted and ignored). An empty table gives an empty one."""
    results = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
    names = others(docs, text_col, *results)
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    rows = docs.select(packed(names), text.alias("t"), F.xxhash64(text).alias("k1"), F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long").alias("k2"))
    long = F.octet_length("t") >= length
    copies = kept(rows.where(long).groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2", F.lit(True).alias("copied")), "suffix_copies")
    n_copies = copies.count()
    sent = F.broadcast(copies) if n_copies <= MOST_SENT else copies
    marked = rows.join(sent, ["k1", "k2"], "left") if n_copies else rows.withColumn("copied", F.lit(None).cast("boolean"))
    marked = marked.withColumn("again", F.coalesce("copied", F.lit(False))).drop("copied")
    columns = ["k1", "k2", "again", "t"]
    once = marked.where(long & ~F.col("again")).select(columns)
    if n_copies:
        once = once.unionByName(marked.where("again").select(columns).dropDuplicates(["k1", "k2"]))
    found = spans(once, length, **how).select(F.col("k1").alias("s1"), F.col("k2").alias("s2"), "spans")
    single = marked.where(~F.col("again")).join(found, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left").select("row", "t", "spans")
    whole = F.array(F.struct(F.lit(0).alias("begin"), F.octet_length("t").alias("end")))
    rows = single.union(marked.where("again").select("row", "t", whole.alias("spans"))) if n_copies else single

    def apply(batches):
        for part, flat, offsets in byte_batches(batches, "t", PIECE_BYTES):
            out: list[list] = [[], [], [], [], []]
            for begin, end, some in zip(offsets, offsets[1:], part.column(2).to_pylist()):
                data, left, at, removed, n = flat[begin:end].tobytes(), [], 0, 0, 0
                stop = -1
                for s in sorted((s["begin"], s["end"]) for s in some or ()):
                    if s[0] > stop:
                        left.append(data[at : s[0]])
                        n += 1
                        removed += s[1] - s[0]
                        stop = at = s[1]
                    elif s[1] > stop:
                        removed += s[1] - stop
                        stop = at = s[1]
                rest = b"".join([*left, data[at:]])
                for column, value in zip(out, (rest.decode("utf-8", "ignore"), len(data), removed, n, hashlib.sha256(rest).hexdigest())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(out, (pa.string(), *results.values())))],
                                             names=["row", "left", *results])

    schema = rows.select("row").schema.add("left", "string").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    done = rows.mapInArrow(apply, schema)
    back = dict(zip(names, unpacked(names)))
    return done.select(*[F.col("left").alias(c) if c == text_col else back[c] for c in docs.columns if c not in results], *results)

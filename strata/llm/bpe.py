"""BPE encoding and decoding by prefix-sharing trie traversal.

For byte-pair encoding the last token of a string's encoding decides the rest: if ``t`` is the last token of a prefix
``p``, the encoding of ``p`` is the encoding of ``p`` without ``t`` followed by ``t``. So one *last-token state* per
prefix describes the encodings of all prefixes. The distinct words of a batch are put in byte order, which is the
depth-first order of their trie; the traversal keeps the states of the current root-to-node path, and a word only adds
the nodes it doesn't share with the word before it. A prefix shared by many words is encoded once.

The state of a node is the one vocabulary entry that ends there and is *compatible* with the state of the node where it
begins: merging the two byte strings together must not build a token across their border. ``Merges.joins`` decides that
from the two derivations and remembers the answer.

Words are cut by array operations over a batch's code points and made distinct by Arrow; only distinct words that the
worker doesn't remember are encoded. The memory is bounded: two generations, of which the older one is dropped when the
younger is full; what is used again moves to the younger, so frequent words stay.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.rows import others, packed, quoted, unpacked
from strata.llm.texts import text_batches

#: Entries per generation of a worker's cache.
CACHE_WORDS = 200_000
#: UTF-8 bytes of text encoded at a time.
BATCH_BYTES = 1 << 20
#: Kinds of characters: letters, numbers, white space, the rest; the last is for those without an assigned meaning in
#: Python's tables, which may have a kind in the library's.
LETTER, NUMBER, SPACE, OTHER, UNSETTLED = range(5)
#: White space outside the categories Z* (fixed values: Unicode's White_Space).
CONTROL_SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85)


def character_kinds() -> np.ndarray:
    """Kind of every code point."""
    by = {"L": LETTER, "N": NUMBER, "Z": SPACE}
    names = [unicodedata.category(chr(c)) for c in range(0x110000)]
    kinds = np.array([UNSETTLED if n == "Cn" else by.get(n[0], OTHER) for n in names], dtype=np.uint8)
    kinds[list(CONTROL_SPACES)] = SPACE
    return kinds


def word_starts(points: np.ndarray, kinds: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the byte-level pre-tokenizer begins a word, for texts in a row that begin at the marked places. Runs of one
    kind are words, with one blank before them if there is one; the last of several white-space characters before other
    text is taken apart from the rest; ``'s 't 'm 'd 're 've 'll`` at the start of a word are words of their own."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    after = np.append(begins[1:], True)  # a text ends behind this character
    fresh = begins.copy()
    fresh[1:] |= kinds[1:] != kinds[:-1]
    space = kinds == SPACE
    before_text = space & ~after
    before_text[:-1] &= ~space[1:]
    starts = fresh | before_text
    held = before_text & (points == 0x20)  # blanks that belong to what follows
    starts[1:] &= ~held[:-1]
    quotes = np.flatnonzero(starts[:-1] & (points[:-1] == 0x27) & ~after[:-1])
    if len(quotes):
        one = points[quotes + 1]
        two = np.where(quotes + 2 < n, points[np.minimum(quotes + 2, n - 1)], 0)
        two = np.where(after[quotes + 1], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        found = quotes[short | long]
        behind = found + np.where(short[short | long], 2, 3)
        starts[found + 1] = False
        starts[behind[behind < n]] = True
    return starts


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Vocabulary and merges of a byte-level BPE file (``tokenizer.json``)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError(f"{path}: a plain byte-level BPE file is expected")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        alphabet = byte_alphabet()
        as_bytes = {w: bytes(alphabet[c] for c in w) for w in model["vocab"]}
        self.ids: dict[bytes, int] = {as_bytes[w]: i for w, i in model["vocab"].items()}
        self.special: dict[str, int] = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that strip or need whole words are not supported")
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            left, right = model["vocab"][a], model["vocab"][b]
            self.rank.setdefault((left, right), r)
            self.parts.setdefault(model["vocab"][a + b], (r, left, right))
        self.known: dict[int, bool] = {}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        table = [b""] * size
        for b, i in self.ids.items():
            table[i] = b
        for s, i in self.special.items():
            table[i] = s.encode()
        self.bytes_of = table

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Symbols that stand at one edge (0 left, 1 right) while the token is built: (symbol, rank at which it is merged)."""
        out, until = [(token, float("inf"))], None
        while token in self.parts:
            until = self.parts[token][0]
            token = self.parts[token][1 + side]
            out.append((token, until))
        return out

    def born(self, token: int) -> float:
        return self.parts[token][0] if token in self.parts else -1

    def joins(self, pair: int) -> bool:
        """True if encoding both tokens' bytes together gives just these two (left << 32 | right): no merge across the
        border comes first. At equal rank the leftmost pair is merged first: the left token's own merge beats the one
        across, the one across beats the right token's."""
        answer = True
        for x, x_until in self.edge(pair >> 32, 1):
            for y, y_until in self.edge(pair & 0xFFFFFFFF, 0):
                r = self.rank.get((x, y))
                if r is not None and r < x_until and r <= y_until and r > self.born(x) and r > self.born(y):
                    answer = False
        if len(self.known) >= 4 * CACHE_WORDS:
            self.known.clear()
        self.known[pair] = answer
        return answer


class Recent:
    """A cache of two generations of bounded size."""

    def __init__(self, most: int = CACHE_WORDS):
        self.most, self.young, self.old = most, {}, {}

    def put(self, new: dict) -> None:
        self.young.update(new)

    def recall(self, wanted: set) -> set:
        """Keys that aren't known; all known ones are in the younger generation afterwards, and stay until the next call."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        missing = wanted - self.young.keys()
        again = missing & self.old.keys()
        self.young.update((k, self.old[k]) for k in again)
        return missing - again


class Encoder:
    """Encodes texts as the file's own library does; distinct words are encoded by trie traversal, or with
    ``by_library`` by the library itself, once for all their occurrences in a batch."""

    def __init__(self, path: str, by_library: bool = False):
        self.merges = Merges(path)
        self.words = Recent()
        self.kinds = character_kinds()
        self.new_words = self.by_library if by_library else self.traverse
        specials = sorted(self.merges.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, specials))) if specials else None
        table = self.merges.bytes_of
        self.lengths = np.array([len(b) for b in table], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1])).astype(np.int64)
        self.flat = np.frombuffer(b"".join(table), dtype=np.uint8)

    def traverse(self, words: set[str]) -> dict[str, bytes]:
        """Depth-first over the trie of the words; gives their ids (little-endian 32-bit)."""
        m, found = self.merges, {}
        ids, known, joins, longest = m.ids.get, m.known.get, m.joins, m.longest
        order = sorted((w.encode("utf-8", "surrogatepass"), w) for w in words)
        room = 1 + max((len(w) for w, _ in order), default=0)
        state, begin, before = [0] * room, [0] * room, b""  # by depth: last token of the prefix, and where it begins
        for word, text in order:
            size, depth, most = len(word), 0, min(len(before), len(word))
            while depth < most and word[depth] == before[depth]:
                depth += 1
            while depth < size:
                depth += 1
                for start in range(depth - longest if depth > longest else 0, depth):
                    token = ids(word[start:depth])
                    if token is not None:
                        if not start:
                            break
                        fits = known((pair := state[start] << 32 | token))
                        if fits or fits is None and joins(pair):
                            break
                state[depth], begin[depth] = token, start
            out = []
            while depth:
                out.append(state[depth])
                depth = begin[depth]
            out.reverse()
            found[text] = pack(f"<{len(out)}I", *out)
            before = word
        return found

    def by_library(self, words: set[str]) -> dict[str, bytes]:
        """Ids of the words from the tokenizers library. Words that begin with one space are handed over in rows, of
        which its pre-tokenizer makes the same words again; the rest one by one."""
        found, row = {}, [w for w in words if w[0] == " " and len(w) > 1 and not w[1].isspace()]
        encode = self.merges.library.encode
        for k in range(0, len(row), 1000):
            some = row[k : k + 1000]
            got = encode("".join(some), add_special_tokens=False)
            ids, of = np.array(got.ids, dtype="<u4"), np.array(got.word_ids, dtype=np.int64)
            cuts = np.flatnonzero(np.diff(of)) + 1
            ends = np.cumsum([len(w) for w in some])
            offsets = np.array(got.offsets, dtype=np.int64).reshape(-1, 2)
            if len(cuts) + 1 == len(some) and (offsets[[*(cuts - 1), len(ids) - 1], 1] == ends).all():
                found.update(zip(some, (x.tobytes() for x in np.split(ids, cuts)), strict=True))
        for w in words - found.keys():
            found[w] = np.array(encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return found

    def learn(self, words: set[str]) -> None:
        unknown = self.words.recall(words)
        if unknown:
            self.words.put(self.new_words(unknown))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(sizes)
        kinds = self.kinds[points]
        begins = np.zeros(len(points) + 1, bool)
        begins[ends - sizes] = True
        cut = np.flatnonzero(word_starts(points, kinds, begins[:-1]))
        width = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)
        place = np.concatenate(([0], np.cumsum(width)))
        offsets = np.append(place[cut], place[-1]).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(cut), [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode())])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn(set(distinct))
        parts = [*map(self.words.young.__getitem__, distinct)]
        pool = np.frombuffer(b"".join(parts), dtype="<u4")
        lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        begin = np.cumsum(lengths) - lengths
        index = coded.indices.to_numpy()
        taken = lengths[index]
        total = np.concatenate(([0], np.cumsum(taken)))
        ids = pool[np.repeat(begin[index] - total[:-1], taken) + np.arange(total[-1])]
        bounds = total[np.searchsorted(cut, np.append(0, ends))]
        out = [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
        odd = {*np.searchsorted(ends, np.flatnonzero(kinds == UNSETTLED), side="right").tolist()}
        if self.specials and self.specials.search(joined):
            odd.update(k for k, t in enumerate(texts) if self.specials.search(t))
        for k in odd:
            out[k] = self.encode_odd(texts[k])
        return out

    def encode_odd(self, text: str) -> bytes:
        """Ids of a text with special tokens, or with characters whose kind only the library knows: cut by it."""
        parts = self._segments(text)
        self.learn({w for p in parts if isinstance(p, list) for w in p})
        get = self.words.young.__getitem__
        return b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in parts)

    def split(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.merges.library.pre_tokenizer.pre_tokenize_str(text)]

    def _segments(self, text: str) -> list:
        """Special tokens as id bytes, what lies between them as word lists."""
        out, at = [], 0
        for m in self.specials.finditer(text) if self.specials else ():
            out += [self.split(text[at : m.start()]), np.array([self.merges.special[m[0]]], dtype="<u4").tobytes()]
            at = m.end()
        return [*out, self.split(text[at:])]

    def decode(self, ids: bytes, piece: int = 1 << 20) -> str:
        """Text of the ids: their byte strings in a row, gathered in pieces of bounded size, read as UTF-8 with
        replacement characters."""
        tokens = np.frombuffer(ids, dtype="<u4")
        return b"".join(self._bytes(tokens[k : k + piece]) for k in range(0, len(tokens), piece)).decode("utf-8", "replace")

    def _bytes(self, tokens: np.ndarray) -> bytes:
        size = self.lengths[tokens]
        ends = np.cumsum(size)
        shift = np.repeat(self.starts[tokens] - (ends - size), size)
        return self.flat[shift + np.arange(len(shift))].tobytes()


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, by_library: bool = False) -> Encoder:
    """One encoder per worker process and file; its caches outlive a task."""
    if (path, by_library) not in _ENCODERS:
        _ENCODERS[path, by_library] = Encoder(path, by_library)
    return _ENCODERS[path, by_library]


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Adds ``ids_col`` (binary: little-endian unsigned 32-bit ids). A null text counts as empty and gives no ids.
    Every other column is kept, whatever its name; an earlier column named ``ids_col`` is replaced. No shuffle."""
    return _mapped(docs, text_col, {ids_col: pa.binary()}, lambda e, texts: [e.encode_batch(texts)], path)


def round_trip(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Per row of ``docs``, without its text: ``n_tokens``, ``ids_sha256`` and, decoded again from the ids,
    ``decoded_sha256``. Ids and decoded texts never leave the task. A null text counts as empty."""

    def digests(e: Encoder, texts: list[str]) -> list[list]:
        ids = e.encode_batch(texts)
        return [[len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids],
                [hashlib.sha256(e.decode(x).encode("utf-8", "surrogatepass")).hexdigest() for x in ids]]

    out = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    return _mapped(docs, text_col, out, digests, path, drop=True)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Replaces ``ids_col`` by ``text_col``: the decoded text, special tokens included (null ids: empty text)."""
    keep = others(encoded, ids_col, text_col)
    rows = encoded.select(packed(keep), F.col(quoted(ids_col)).alias("ids"))

    def run(batches):
        e = encoder(path)
        for batch in batches:
            texts = [e.decode(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    return rows.mapInArrow(run, rows.select("row").schema.add("text", "string")).select(*unpacked(keep), F.col("text").alias(text_col))


def _mapped(docs, text_col, added, work, path, drop=False) -> DataFrame:
    """Other columns travel by number, whatever their names; the text once, also if it is kept."""
    from pyspark.sql.pandas.types import from_arrow_type

    keep = others(docs, *added, *([text_col] if drop else []))
    held = text_col in keep
    text = f"c{keep.index(text_col)}" if held else "t"
    numbered = [f"c{k}" for k in range(len(keep))]
    rows = docs.select(*[F.col(quoted(c)).alias(n) for c, n in zip(keep, numbered)], *([] if held else [F.col(quoted(text_col)).alias("t")]))

    def run(batches):
        e = encoder(path)
        for part, texts in text_batches(batches, text, BATCH_BYTES):
            new = work(e, texts)
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *(pa.array(v, t) for v, t in zip(new, added.values(), strict=True))],
                                             names=[*numbered, *(f"a{k}" for k in range(len(added)))])

    schema = rows.select(*numbered).schema
    for k, kind in enumerate(added.values()):
        schema = schema.add(f"a{k}", from_arrow_type(kind))
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, numbered)], *[F.col(f"a{k}").alias(c) for k, c in enumerate(added)])

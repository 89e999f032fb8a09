"""Operators against brute force, the tokenizers library, held-out labels and DuckDB, on small tables."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from strata.llm import bpe, caps, classifier, mixing, queries, repetition, revisits, simhash, suffixes, token_files, url_filters
from strata.llm.components import components
from strata.session import scratch_dir

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
ODD = ["a", "b", " ", "\n", "\t", "'s", "<|endoftext|>", "é", "　", "1", "!", "  ", "\x1c", "\x85", "՘", "日", "𝔘", "don't", "Ƛ",
       "\r\n", "'", "'ll", "'re", "'v", " ", "²", "don’t", " 's"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


# ---------------------------------------------------------------- components
def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i + 1000, i + 1001) for i in range(40)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == roots({x for e in real for x in e}, real)


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- BPE
@pytest.mark.parametrize("by_library", [False, True])
def test_encoder_equals_library(by_library):
    e = bpe.Encoder(queries.tokenizer_path(), by_library)
    texts = odd_texts(4000) + ["", "   x", "word " * 3000]
    got = [x for k in range(0, len(texts), 500) for x in e.encode_batch(texts[k : k + 500])]
    for text, ids in zip(texts, got):
        want = e.merges.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert e.decode(ids) == e.merges.library.decode(want, skip_special_tokens=False)
    assert e.encode_batch([]) == [] and e.encode_batch([""]) == [b""]


def test_full_caches_change_nothing():
    small, large = bpe.Encoder(queries.tokenizer_path()), bpe.Encoder(queries.tokenizer_path())
    small.words.most = 3
    texts = odd_texts(300, seed=4)
    assert [small.encode_batch([t])[0] for t in texts] == large.encode_batch(texts)


def test_round_trip_keeps_other_columns_and_counts_null_as_empty(spark):
    docs = spark.createDataFrame([(1, None, "x", 5), (1, "a b", "y", 6), (None, "", None, 7)], "doc_id long, text string, n_tokens string, `odd name` int").withColumn("a.b", F.lit(1)).withColumn("t", F.lit(2))
    rows = bpe.round_trip(docs, queries.tokenizer_path()).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.doc_id, r["odd name"], r.n_tokens) for r in rows] == [(1, 5, 0), (1, 6, 2), (None, 7, 0)]
    assert rows[0].ids_sha256 == rows[2].decoded_sha256 == empty
    back = bpe.decode(bpe.encode(docs, queries.tokenizer_path()), queries.tokenizer_path())
    assert [r.text for r in back.collect()] == ["", "a b", ""]
    assert bpe.round_trip(docs.limit(0), queries.tokenizer_path()).count() == 0


# ---------------------------------------------------------------- token files
def test_token_files_round_trip(spark):
    texts = [(k, t) for k, t in enumerate(odd_texts(120, seed=9))] + [(None, "null id"), (500, None), (500, "twice"), (500, "twice")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("start", F.lit("clash"))
    folder = scratch_dir(spark, "token_files")
    manifest = token_files.write(docs, queries.tokenizer_path(), folder, end_id=2, shards=5)
    got = token_files.read(spark, manifest, folder).orderBy("start").collect()
    library = bpe.Encoder(queries.tokenizer_path()).merges.library
    want = Counter()
    for k, t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want[k, len(ids) // 4, zlib.crc32(ids)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    text_ids = docs.select(F.concat(F.lit("id"), "doc_id").alias("doc_id"), "text")
    named = token_files.write(text_ids, queries.tokenizer_path(), folder + "-text", end_id=2)
    assert Counter(r.doc_id for r in token_files.read(spark, named, folder + "-text").collect()) == Counter(r.doc_id for r in text_ids.collect())
    none = token_files.write(docs.limit(0), queries.tokenizer_path(), folder + "-none", end_id=2)
    assert token_files.read(spark, none, folder + "-none").count() == 0


# ---------------------------------------------------------------- SimHash
def brute_fingerprint(text, n=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + n]).encode(), 42) for k in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(4000)}" for _ in range(rng.randint(0, 500))] for _ in range(15)]
    texts = [None, "", " \t", "One", "one two", "ONE TWO", "É a b", "é a b"]
    for w in base:
        for _ in range(12):
            v = list(w)
            if v:
                v[rng.randrange(len(v))] = "new"
            texts.append(" ".join(v))
    docs = spark.createDataFrame([(k * 3, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, fp string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = {k * 3: brute_fingerprint(t) for k, t in enumerate(texts)}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert any(prints[a] != prints[b] for a, b in pairs)
    of = roots(prints, pairs)
    assert got == {k: (f"{v:016x}", of[k]) for k, v in prints.items()}


def test_links_of_planted_bits(spark):
    rng = random.Random(6)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for bits in (1, 2, 3):
            q = p
            for b in rng.sample(range(64), bits):
                q ^= 1 << b
            prints.add(q)
    prints |= {0, 1, 2, 3, 7, (1 << 64) - 1, (1 << 64) - 2}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}


# ---------------------------------------------------------------- URL filters
def test_url_filters_edges(spark):
    entries = spark.createDataFrame([
        ("block", "a.org", "add", "2024-01-01"), ("block", "a.org", "remove", "2024-01-05"), ("block", "a.org", "add", "2024-01-09"),
        ("allow", "a.org/x", "add", "2024-01-02"), ("block", "b.org", "add", "2024-01-03"), ("block", "b.org", "remove", "2024-01-03"),
        ("block", "b.org", "add", "2024-01-03"), (None, "c.org", "add", "2024-01-01"), ("block", None, "add", "2024-01-01")],
        "list string, pattern string, action string, at string").withColumn("at", F.to_date("at"))
    rows = [(1, "http://A.org/", "2024-01-01"), (2, "http://sub.a.org/x", "2024-01-04"), (3, "http://a.org/x/y?q", "2024-01-04"),
            (4, "http://a.org/xy", "2024-01-05"), (5, "http://a.org", "2024-01-09"), (6, "http://b.org", "2024-01-09"), (7, None, "2024-01-09"),
            (8, "no url", "2024-01-09"), (9, "http://a.org", None), (10, "http://a.org", "2023-12-31"), (1, "http://A.org/", "2024-01-01")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched string").withColumn("fetched", F.to_date("fetched")).withColumn("blocked", F.lit("clash")).withColumn("t", F.lit(1)).withColumn("n", F.lit(1)).withColumn("d", F.lit(1))
    got = sorted((r.page_id, r.n_active, r.decided_by, r.blocked) for r in url_filters.evaluate(captures, entries).collect())
    assert got == [(1, 1, "a.org", True), (1, 1, "a.org", True), (2, 1, "a.org", True), (3, 2, "a.org/x", False), (4, 0, None, False),
                   (5, 1, "a.org", True), (6, 0, None, False), (7, 0, None, False), (8, 0, None, False), (9, 0, None, False), (10, 0, None, False)]
    assert url_filters.evaluate(captures.limit(0), entries.limit(0)).count() == 0


# ---------------------------------------------------------------- repetition
def brute_measures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(win)
    covered = {i + k for i, x in enumerate(win) if n[x] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), sum(len(w[i]) for i in covered)


def test_repetition_equals_brute_force(spark):
    rng = random.Random(8)
    bits = ["a", "b", " ", "\n", "é", "| ", "\t", "a b c d e f g h i j\n", "𝔘 "]
    texts = [None, "", "\n\n", " "] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 70))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kept", F.lit("clash"))
    for r in repetition.rules(docs).collect():
        want = brute_measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.dup_8_chars) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.kept and r.base_failed)
    assert repetition.rules(docs.limit(0)).count() == 0


def test_repetition_limits_decide_and_later_occurrences_count(spark):
    """A passage of 12 words twice in a text: a quarter of its characters in repeated 10-grams is too much, an eighth is not."""
    unlike = [f"w{k:04d}" for k in range(2000)]
    rows = [(n, " ".join(unlike[:12] + unlike[20 : 20 + n] + unlike[:12]), "x") for n in (60, 80, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    got = {r.doc_id: r for r in repetition.rules(docs).collect()}
    assert {k: r.later_10_chars for k, r in got.items()} == {k: 60 for k in got} and {r.dup_10_chars for r in got.values()} == {120}
    assert {k: (r.base_failed, r.kept) for k, r in got.items()} == {60: (False, False), 80: (False, True), 200: (False, True)}


def thue_morse(n, a, b):
    out = [a]
    while len(out) < n:
        out += [b if c == a else a for c in out]
    return "".join(out)


@pytest.mark.parametrize("n", [256, 1024, 8192])
def test_lines_and_words_that_collide_under_powers_of_two_are_told_apart(n):
    x, y = thue_morse(n, "a", "b"), thue_morse(n, "b", "a")
    window = " ".join(["w"] * 3)
    data = f"{x}\n{y}\n{x} {window} 1 2 3 4 {y} {window} 1 2 3 4".encode()
    got = repetition.measure(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert (got["n_dup_lines"].tolist(), got["n_repeat_words"].tolist(), got["dup_7_chars"].tolist()) == ([0], [0], [14])


# ---------------------------------------------------------------- suffix arrays
def brute_removal(texts, length):
    data = [(t or "").encode() for t in texts]
    n = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        hit = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                hit[i : i + length] = b"\x01" * length
        kept = bytes(x for x, y in zip(b, hit) if not y)
        out.append((len(b), sum(hit), len(re.findall(b"\x01+", bytes(hit))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("how", [{}, {"group_segments": 2}, {"gram": None}])
def test_removal_equals_brute_force(spark, how):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(0, 90))) for _ in range(8)] + ["a" * 70, "ab" * 40, "|" * 72, "a" * 55 + "b"]
    texts = ["".join(rng.choice(base) if rng.random() < 0.6 else "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
                     for _ in range(rng.randint(0, 5))) for _ in range(250)] + [None, "", "x" * 500, "x" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_spans", F.lit("clash")).withColumn("t", F.lit(1)).withColumn("a.b", F.lit(1))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs, length=20, **{"gram": 8, **how}).collect()}
    assert got == dict(enumerate(brute_removal(texts, 20)))


def test_removal_of_long_passages_with_production_lengths(spark):
    """Passages under, at and over 400 bytes, some with one byte changed, behind a line that nearly all texts share."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, passages = text(80) + "\n", [text(n) for n in (399, 400, 401, 700, 1500)]
    texts = []
    for _ in range(60):
        some = rng.choice(passages)
        if rng.random() < 0.3:
            at = rng.randrange(len(some))
            some = some[:at] + "#" + some[at + 1 :]
        texts.append(text(rng.randint(0, 300)) + line * rng.randint(0, 2) + some + text(rng.randint(0, 300)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs).collect()}
    assert got == dict(enumerate(brute_removal(texts, 400)))


def test_removal_of_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "y" * 10 + "q" * 15), (None, "y" * 10 + "q" * 15), (3, None)], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed, r.text) for r in suffixes.remove_repeats(docs, length=20, gram=8).collect())
    assert got == [(0, 0, ""), (25, 25, ""), (25, 25, "")]
    assert suffixes.remove_repeats(docs.limit(0), length=20, gram=8).count() == 0


def test_copies_of_a_row_are_fetched_once(spark, monkeypatch):
    rng = random.Random(8)
    passage, tails = " ".join(str(rng.random()) for _ in range(60)), [str(rng.random()) * 9 for _ in range(2)]
    rows = [(None, passage + tails[0])] * 30 + [(2, tails[1] + passage)]
    seen, write = [], suffixes.kept

    def count(df, purpose):
        out = write(df, purpose)
        if purpose == "suffix_parts":
            seen.append((out.count(), out.select("gram", "whole").distinct().count()))
        return out

    monkeypatch.setattr(suffixes, "kept", count)
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=100).collect()
    assert seen and seen[0][0] == seen[0][1] > 0
    want = brute_removal([t for _, t in rows], 100)
    assert Counter((r.n_bytes, r.n_removed) for r in got) == Counter(w[:2] for w in want)


def test_spans_come_from_pieces_not_from_segments(spark):
    """Near copies with a hundred repeated segments each: what follows the runs has a row per text and piece, not one per text and segment."""
    rng = random.Random(3)
    common = "".join(rng.choice("abcdefgh") for _ in range(1500))
    texts = [common + f"<{k}>" + common[::-1] for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "k1 long, t string").selectExpr("k1", "k1 * 7 AS k2", "k1 < 0 AS again", "t")
    found = suffixes.spans(docs, length=20, gram=8)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "gather" in plan
    n = Counter(t[i : i + 20] for t in texts for i in range(len(t) - 19))
    want = {k: {x for i in range(len(t) - 19) if n[t[i : i + 20]] > 1 for x in range(i, i + 20)} for k, t in enumerate(texts)}
    assert {r.k1: {x for s in r.spans for x in range(s.begin, s.end)} for r in found.collect()} == want


def test_piece_spans_equal_plain_union():
    rng = random.Random(4)
    found = [{"places": [{"k1": rng.randrange(-2, 2), "k2": rng.randrange(2), "begin": rng.randrange(300), "again": False} for _ in range(rng.randint(1, 4))],
              "runs": [{"from": a, "to": a + rng.randint(1, 9)} for a in sorted(rng.sample(range(40), rng.randint(1, 3)))]} for _ in range(25)]
    place, run = pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("begin", pa.int32()), ("again", pa.bool_())]), pa.struct([("from", pa.int32()), ("to", pa.int32())])
    array = pa.array([[], found], pa.list_(pa.struct([("places", pa.list_(place)), ("runs", pa.list_(run))])))
    want = {}
    for f in found:
        for at in f["places"]:
            for r in f["runs"]:
                want.setdefault((at["k1"], at["k2"]), set()).update(range(at["begin"] + r["from"], at["begin"] + r["to"] + 5))
    got = suffixes.piece_spans(array[1].values, 6).to_pylist()
    assert {(r["k1"], r["k2"]): {x for s in r["spans"] for x in range(s["begin"], s["end"])} for r in got} == want and len(got) == len(want)
    assert all(a["end"] < b["begin"] for r in got for a, b in zip(r["spans"], r["spans"][1:]))


@pytest.mark.parametrize("most_sent", [0, 200_000])
def test_long_texts_in_parts_and_copies_by_shuffle(spark, monkeypatch, most_sent):
    """Texts far longer than a piece, with repeats in themselves and each other, across the borders of parts; copies of them."""
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 300)
    monkeypatch.setattr(suffixes, "MOST_SENT", most_sent)
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [text(n) for n in (25, 90, 350, 900)]
    texts = [text(rng.randint(0, 400)) + rng.choice(shared) + text(rng.randint(0, 900)) + rng.choice(shared) for _ in range(25)] + ["", None, text(19), text(20)]
    texts += [texts[0]] * 30 + [texts[1]] * 2 + [texts[-1]] * 2 + [texts[-2]] * 3
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    got = Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs, length=20, gram=8).collect())
    assert got == Counter(brute_removal(texts, 20))


def test_parts_cover_every_window_once():
    flat, offsets, length, most = np.arange(1000) % 251, np.array([0, 0, 5, 700, 1000]), 20, 64
    seen = Counter()
    for k, base, part, cuts in suffixes.text_parts(flat, offsets, length, most):
        assert len(part) < most + length and part.tolist() == flat[offsets[k] + base : offsets[k] + base + len(part)].tolist()
        seen.update((k, base + w) for w in range(len(part) - length + 1))
    assert seen == Counter((k, w) for k in range(4) for w in range(offsets[k + 1] - offsets[k] - length + 1))


def test_suffix_order():
    data = np.frombuffer(b"mississippi" * 3, np.uint8)
    begins, ends = np.array([0]), np.array([len(data)])
    raw = data.tobytes()
    got = suffixes.suffix_array(data, begins, np.array([len(data)]), ends, len(data))
    assert got.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


# ---------------------------------------------------------------- mixing
def test_mix_meets_its_limits(spark):
    docs = spark.createDataFrame([(k, "big" if k % 10 else "small", "w " * (1 + k % 7)) for k in range(3000)] + [(None, None, "a b"), (1, "none", None)],
                                 "doc_id long, source string, text string").withColumn("epoch", F.lit("clash")).withColumn("s", F.lit(1)).withColumn("__p", F.lit(1)).withColumn("a.b", F.lit(1))
    rows = mixing.mix(docs, queries.words(F.col("text")), max_epochs=2.0, budget=1.0).collect()
    total = sum(1 + k % 7 for k in range(3000)) + 2
    assert 0.95 * total <= sum(r.tokens for r in rows) <= total
    assert max(Counter((r.doc_id, r.source) for r in rows).values()) <= 2
    whole = mixing.mix(docs, queries.words(F.col("text")), max_epochs=1.5, budget=None).collect()
    assert {(r.doc_id, r.source) for r in whole} == {(r.doc_id, r.source) for r in docs.collect()}
    assert mixing.mix(docs.limit(0), queries.words(F.col("text")), max_epochs=2.0).count() == 0


def test_mix_fills_past_a_very_long_document(spark):
    one = [(0, "a", 900)] + [(k, s, 1) for s, begin in (("b", 1000), ("c", 2000), ("d", 3000)) for k in range(begin, begin + 300)]
    docs = spark.createDataFrame(one, "doc_id long, source string, n long")
    got = Counter(r.source for r in mixing.mix(docs, F.col("n"), max_epochs=2.0).collect())
    assert got["a"] == 1 and got["b"] == got["c"] == got["d"] == 450  # the only document of a is larger than its quota
    for seed in range(1, 4):
        giant = [(0, "hot", 5000)] + [(k, "hot", 1 + k % 9) for k in range(1, 4000)] + [(k, f"s{k % 6}", 1) for k in range(10000, 13000)]
        docs = spark.createDataFrame(giant, "doc_id long, source string, n long")
        rows = mixing.mix(docs, F.col("n"), max_epochs=8.0, seed=seed).collect()
        total = sum(n for _, _, n in giant)
        shares = {s: sum(n for _, x, n in giant if x == s) for _, s, _ in giant}
        a = mixing.exponent(spark.createDataFrame(list(shares.items()), "s string, tokens long"), 8.0)
        weight = {s: (n / total) ** a for s, n in shares.items()}
        for s, w in weight.items():
            quota = total * w / sum(weight.values())
            mine = [r for r in rows if r.source == s]
            assert 0.995 * quota - 1 <= sum(r.tokens for r in mine) <= quota + 1
            assert len({(r.doc_id, r.epoch) for r in mine}) == len(mine)


@pytest.mark.parametrize("most", [900, 20_000])
def test_mixing_query_equals_sql_with_a_giant_document(spark, tmp_path, most):
    """A source of one document longer than its quota, a hot source with a very long one, null sources, ids and texts, repeated rows."""
    rows = [(0, "lone", "w " * most), (1, "hot", "w " * 6000), (None, None, "a b c"), (5, None, None), (5, "empty", "")]
    rows += [(k, "hot", "w " * (1 + k % 9)) for k in range(2, 1500)] + [(k, f"s{k % 4}", "w " * 3) for k in range(3000, 4000)] + [(3000, "s0", "w w w")] * 2
    spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in queries.op7_mixing(spark, str(tmp_path)).select("doc_id", "source", "tokens", "epoch", "turn").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == Counter(con.sql(f"SELECT doc_id, source, tokens, epoch, turn FROM ({queries.ORACLE['op7_mixing']})").fetchall())
    assert {s for _, s, *_ in got} >= {"lone", "hot", "s0", "s1", "s2", "s3"}


def test_exponent_meets_entropy(spark):
    shares = spark.createDataFrame([("a", 800), ("b", 150), ("c", 50)], "s string, tokens long")
    a = mixing.exponent(shares, entropy=0.9)
    w = np.array([0.8, 0.15, 0.05]) ** a
    w /= w.sum()
    assert 0 <= -(w * np.log(w)).sum() - 0.9 < 1e-5
    assert mixing.exponent(shares, entropy=2.0) == 0.0 and mixing.exponent(shares, entropy=0.1) == 1.0
    with pytest.raises(ValueError):
        mixing.exponent(shares)


# ---------------------------------------------------------------- revisits
def test_revisit_edges(spark):
    rows = [(1, "http://a.org/#x", "2024-01-01", "response", '"e"', "m", {"etag": '"e"', "content-length": "9", "date": "d1"}, "D1"),
            (2, "https://www.a.org", "2024-01-02", "revisit", 'W/"e"', None, {"date": "d2", "content-length": "0"}, None),
            (3, "http://a.org", "2024-01-01", "revisit", '"e"', None, None, None),   # not earlier
            (4, "http://a.org", "2024-01-03", "revisit", None, "m", {}, None),
            (5, "http://a.org", "2024-01-03", "revisit", None, None, {}, None),
            (6, "http://a.org", "2024-01-03", "revisit", '"x"', "m", {}, None),
            (7, None, "2024-01-03", "revisit", '"e"', None, {}, None), (8, "http://a.org", None, "revisit", '"e"', None, {}, None),
            (9, "http://a.org", "2024-01-03", None, None, None, None, None)]
    records = spark.createDataFrame(rows, "record_id long, url string, at string, kind string, etag string, last_modified string, headers map<string,string>, digest string")
    records = records.withColumn("at", F.to_date("at")).withColumn("status", F.lit("clash"))
    got = {r.record_id: (r.status, r.refers_to, r.digest) for r in revisits.resolve(records).collect()}
    assert got == {1: ("full", None, "D1"), 2: ("resolved", 1, "D1"), 3: ("no_response", None, None), 4: ("resolved", 1, "D1"), 5: ("no_validator", None, None),
                   6: ("validator_mismatch", None, None), 7: ("no_response", None, None), 8: ("no_response", None, None), 9: (None, None, None)}
    two = revisits.resolve(records).where("record_id = 2").first()
    assert two.headers == {"etag": '"e"', "content-length": "9", "date": "d2"}
    assert revisits.resolve(records.limit(0)).count() == 0


# ---------------------------------------------------------------- classifier
def test_classifier_on_held_out_labels(spark):
    rows = queries.op9_quality(spark, SF01).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    judged = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert sum(p == q for p, q in judged) >= 0.95 * len(judged)


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, "x"), (None, "a" * 10000)], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (9, 0), (2, None)], "doc_id long, quality int")
    shares, constant = classifier.train(docs, labels)
    assert not shares.any()
    rows = classifier.score(docs, (shares, constant)).collect()
    assert len(rows) == 4 and all(abs(r.score - 2 / 3) < 1e-9 for r in rows)
    assert classifier.score(docs.limit(0), classifier.train(docs, labels.limit(0))).count() == 0


# ---------------------------------------------------------------- caps
def brute_links(rows):
    sound = [k for k, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, pairs = Counter(), []
    for a in sound:
        for b in sound:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    links.update((a, b))
                    pairs.append((a, b))
    of = roots(range(len(rows)), pairs)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[of[k]] = min(least.get(of[k], i), i)
    return {i: (links[k], least[of[k]], least[of[k]] == i) for k, (i, _, _) in enumerate(rows)}


@pytest.mark.parametrize("code", [caps.Code(), caps.Code(block_rows=4)])
def test_caps_equal_brute_force(spark, code):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    v, label = rows[3][1], rows[3][2]
    near = [[x + 0.03 * ((k * 7 + j) % 5 - 2) / 5 for j, x in enumerate(v)] for k in range(9)]
    rows += [(5000 - k, x, label) for k, x in enumerate(near)] + [(6000 + k, v, label) for k in range(5)]
    rows += [(7000, None, 1), (7001, [0.0] * 64, 1), (7002, [float("nan")] * 64, 1), (7003, v, None), (7004, [2 * x for x in v], label), (7005, v[:10], label),
             (7006, [None] * 64, 1), (7007, [], 1), (7008, [float("inf")] * 64, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("kept", F.lit(0)).withColumn("node", F.lit(0))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in caps.near_duplicates(df, code=code).collect()}
    assert got == brute_links([(r.vec_id, r.embedding, r.label) for r in df.collect()])


def test_list_decoding_finds_all_directions_over_the_cap():
    code = caps.Code(least=1)
    x = np.random.default_rng(2).standard_normal((50, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn, places, book = code.words(64)
    all_products = (x @ turn[:, places[0]]) @ book[0].T
    for p, w in zip(places[1:], book[1:]):
        all_products = (all_products[:, :, None] + ((x @ turn[:, p]) @ w.T)[:, None, :]).reshape(len(x), -1)
    for mine, products in zip(caps.list_decode(x, code), all_products):
        want = np.flatnonzero(products >= code.cap)
        if len(want):
            assert mine.tolist() == want.tolist()


# ---------------------------------------------------------------- SQL twins, pipeline
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF001)
    rel = con.sql(queries.ORACLE[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert sorted(tuple(str(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(str(r[k]) for k in at) for r in rel.fetchall())


def test_entry_registers_all():
    assert {*queries.QUERIES, "pipeline"} <= set(E.queries()) and set(queries.ORACLE) <= set(E.oracle_sql())
    assert os.path.isabs(queries.tokenizer_path())


def test_pipeline_equals_brute_force(spark):
    """Every stage on the whole table, and the whole run: fingerprints, removed bytes and tokens by plain loops from what the classifier keeps."""
    docs = queries.documents(spark, SF001)
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]

    def representatives(rows):
        prints = {r.doc_id: brute_fingerprint(r.text) for r in rows}
        by = {}
        for i, p in prints.items():
            by.setdefault(p, []).append(i)
        pairs = [(a[0], b[0]) for p, a in by.items() for q, b in by.items() if p < q and (p ^ q).bit_count() <= 2]
        return set(roots(prints, pairs + [(a[0], x) for a in by.values() for x in a[1:]]).values())

    def left(rows):
        data = [r.text.encode() for r in rows]
        n = Counter(b[i : i + 400] for b in data for i in range(len(b) - 399))
        out = {}
        for r, b in zip(rows, data):
            hit = bytearray(len(b))
            for i in range(len(b) - 399):
                if n[b[i : i + 400]] > 1:
                    hit[i : i + 400] = b"\x01" * 400
            out[r.doc_id] = bytes(x for x, y in zip(b, hit) if not y).decode("utf-8", "ignore")
        return out

    every = docs.collect()
    one = corpus_pipeline.near_duplicates(spark, docs, SF001)
    assert sorted(r.doc_id for r in one.collect()) == sorted(representatives(every))
    assert {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.repeated_passages(spark, docs, SF001).collect()} == {
        i: (t, len(t)) for i, t in left(every).items()}
    mixed = corpus_pipeline.source_mix(spark, docs, SF001)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} == {r.doc_id for r in every}
    good = corpus_pipeline.quality(spark, docs, SF001)
    rows = good.collect()
    assert good.columns == docs.columns and 0.5 * len(every) < len(rows) < len(every)
    stay = representatives(rows)
    rows = [r for r in rows if r.doc_id in stay]
    texts = left(rows)
    third = spark.createDataFrame([(r.doc_id, texts[r.doc_id], r.lang, r.source, len(texts[r.doc_id])) for r in rows], docs.schema)
    library = bpe.encoder(queries.tokenizer_path()).merges.library
    want = Counter()
    for r in corpus_pipeline.source_mix(spark, third, SF001).collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()] += 1
    got = corpus_pipeline.run(spark, SF001)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in got.collect()) == want


def test_pipeline_stages_with_odd_rows(spark):
    """Null ids, sources and texts, repeated rows and ids, extra columns with names that the stages use, and no rows."""
    docs = queries.documents(spark, SF001)
    some = docs.limit(60).collect()
    odd = [(None, None, None, None, None), (None, "x y z " * 30, "en", None, 180), (None, "x y z " * 30, "en", None, 180), (7, "", "en", "web", 0),
           (some[0].doc_id, some[0].text, "xx", "other", 1), (some[1].doc_id, "another text of one id " * 20, "en", "web", 9)]
    rows = [tuple(r) for r in some] + [tuple(some[2])] * 3 + odd
    extra = {"score": 1, "id": 2, "h": 3, "rows": 4, "s": 5, "t": 6, "row": 7, "a.b": 8, "__p": 9, "epoch": 10, "spans": 11}
    frame = spark.createDataFrame(rows, docs.schema).withColumns({k: F.lit(v) for k, v in extra.items() if k != "a.b"}).withColumn("a.b", F.lit(8))
    n = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, frame, SF001)
        assert out.columns == frame.columns
        found = out.collect()
        assert all(r[k] == v for r in found for k, v in extra.items() if k != "epoch")
        n[name] = found
        assert stage(spark, frame.limit(0), SF001).count() == 0
    near = n["simhash near-dedup"]
    assert len([r for r in near if r.doc_id == some[2].doc_id]) <= 1 and len([r for r in near if r.doc_id is None and r.text]) == 1
    assert len(n["suffix-array dedup"]) == len(rows) and len(n["source mix"]) >= len(rows)
    tokens = corpus_pipeline.tokens(spark, frame, SF001)
    assert tokens.count() == len(rows) and corpus_pipeline.tokens(spark, frame.limit(0), SF001).count() == 0


def plain_features(text: bytes, s):
    """(group, bucket) of a text's features, one after the other."""
    full = (1 << 64) - 1

    def mix(x):
        for _ in range(2):
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & full
        return x ^ x >> 32

    words, out = re.findall(rb"[^\x20\x09-\x0D]+", text), []
    from strata.llm import rolling
    hashes = [mix((sum(int(rolling.TABLE[b]) * pow(rolling.BASE, k, 1 << 64) for k, b in enumerate(w)) + len(w) * 0xC2B2AE3D27D4EB4F) & full) for w in words]
    out += [(0, h >> 64 - s.buckets_log2) for h in hashes]
    out += [(0, mix(1 if a == b else (b + 3 * a) & full) >> 64 - s.buckets_log2) for a, b in zip(hashes, hashes[1:])]
    for w in words:
        line = b" " + w + b" "
        for n in s.grams:
            for k in range(len(line) - n + 1):
                h = line[k]
                for b in line[k + 1 : k + n]:
                    h = (h * 0x01000193 & 0xFFFFFFFF) ^ b
                h = (h ^ (n * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF
                h = (h ^ h >> 15) * 0xC2B2AE35 & 0xFFFFFFFF
                out.append((1, h >> 32 - s.buckets_log2))
    return out


def test_scores_equal_a_plain_loop(spark, monkeypatch):
    rng = random.Random(3)
    s = classifier.Settings()
    shares = np.random.default_rng(1).normal(size=1 << s.buckets_log2).astype(np.float32)
    bits = ["a", "bc", " ", "\n", "é", "日本", "the", "  ", "x" * 40]
    texts = [None, "", " ", "a", "a a"] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(80)] + ["word é " * 300, "y" * 900 + " z"]
    want = {}
    for k, t in enumerate(texts):
        found = plain_features((t or "").encode(), s)
        means = [[shares[b] for g, b in found if g == group] for group in (0, 1)]
        want[k] = 1 / (1 + np.exp(-(0.5 * sum(np.mean(np.array(m, np.float64)) if m else 0.0 for m in means) + 0.25)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("a.b", F.lit(1)).withColumn("t", F.lit(2)).withColumn("c0", F.lit(3))
    for piece in (classifier.PIECE_BYTES, 100):   # long texts are cut at words
        monkeypatch.setattr(classifier, "PIECE_BYTES", piece)
        got = {r.doc_id: r.score for r in classifier.score(docs, (shares, 0.25)).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        flat = "word é ".encode() * 300
        whole = classifier.logits(np.frombuffer(flat, np.uint8), np.array([0, len(flat)]), shares, s, piece)
        assert abs(1 / (1 + np.exp(-(whole[0] + 0.25))) - want[85]) < 1e-9


def test_weights_equal_a_plain_loop():
    s = classifier.Settings()
    texts = [b"", b"a", "é word word".encode(), b"one two  three"]
    bucket, doc, weight = classifier.weighted(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), s)
    got = Counter()
    for b, d, w in zip(bucket.tolist(), doc.tolist(), weight.tolist()):
        got[d, b] += w
    want = Counter()
    for d, t in enumerate(texts):
        found = plain_features(t, s)
        for g, b in found:
            want[d, b] += 0.5 / sum(x == g for x, _ in found)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)

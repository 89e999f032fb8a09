"""Fill-in-the-middle, spelling variants and chat formatting against plain loops."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.llm import chat, fill_in_middle as fim, queries, spelling
from strata.llm.templates import Template, TemplateError

SF001 = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- fill-in-the-middle
def brute_fim(doc_id, text, unit="words"):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text) if unit == "words" else list(text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 20
    return n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["words", "chars"])
def test_fim_equals_brute_force(spark, unit):
    rng = random.Random(4)
    bits = ["a", "Bc", " ", "é", "日", "𝔘", "\n", "<", ">", "<P", "P>", "<S>", "1", "x" * 50, "́"]
    texts = [None, "", "<M>", "é", "𝔘𝔘"] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    texts.append("".join(rng.choice("ab é日") for _ in range(300_000)))
    rows = [(k if k % 7 else None, t, "x", k) for k, t in enumerate(texts)] + [(3, "same", "x", -1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, `a.b` long")
    s = fim.Settings(unit=unit)
    got = fim.transform(docs, s).withColumn("back", fim.restored(F.col("output"), F.col("form"), s)).collect()
    want = Counter((k, *brute_fim(i, t, unit), t or "") for i, t, _, k in rows)
    assert Counter((r["a.b"], r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(docs.limit(0)).count() == 0


@given(st.text(alphabet="aé日𝔘\n", max_size=40))
def test_exception_index(text):
    data = text.encode()
    index = fim.ExceptionIndex(np.frombuffer(data, np.uint8))
    assert len(index.byte) == sum(ord(c) > 127 for c in text)
    for k in range(len(text) + 1):
        at = len(text[:k].encode())
        assert index.bytes(k) == at and index.points(at) == k


def test_fim_sentinels_must_be_apart():
    for bad in (("<P>", "<P>x", "<M>"), ("ab", "bc", "x"), ("", "a", "b"), ("a", "a", "b")):
        with pytest.raises(ValueError):
            fim.Settings(sentinels=bad)


# ---------------------------------------------------------------- spelling
def brute_words(rows, every=97):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(vocabulary):
    near = defaultdict(set)
    words = sorted(vocabulary)
    for a in words:
        for b in words:
            if a < b and abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-vocabulary[x], x), default=None)
        if best and vocabulary[best] >= 2 * vocabulary[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), vocabulary.get(form.get(w))) for w, n in vocabulary.items()}


@pytest.mark.parametrize("group_words", [2, 64])
def test_variants_equal_brute_force(spark, group_words):
    """Words over few letters (many near ones), words with one long prefix or ending, a chain of ever rarer forms."""
    rng = random.Random(6)
    some = ["".join(rng.choice("abé") for _ in range(rng.randint(3, 8))) for _ in range(250)]
    some += ["unter" + "".join(rng.choice("klm") for _ in range(rng.randint(1, 5))) for _ in range(120)]
    some += ["".join(rng.choice("klm") for _ in range(rng.randint(1, 5))) + "ungen" for _ in range(120)]
    chain = ["ZÀÿzzzz" + "q" * k for k in range(6)]
    words = [w for w in some for _ in range(rng.randint(1, 12))] + [w for k, w in enumerate(chain) for _ in range(3 * 2 ** (6 - k))]
    rng.shuffle(words)
    texts = [(k if k % 9 else None, " ".join(words[k * 20 : k * 20 + 20]).replace("a", "A") + "-日") for k in range(-(-len(words) // 20))]
    texts += [(-1, None), (-2, ""), (-3, "1 2 ñ"), (-4, "abcde" * 2000)] * 3
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("x.n", F.lit(1))
    got = {tuple(r) for r in spelling.variants(docs, group_words=group_words).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = brute_variants(brute_words(texts))
    assert got == want and any(f and r != f for _, f, r, *_ in want)
    assert spelling.variants(docs.limit(0)).count() == 0


def test_near_pairs_come_once_and_hot_chunks_go_deeper(spark):
    words = {"", "a", "b", "ab", "ba", "aab", "日本語", "日本", "𝔘𝔘𝔘", "𝔘é𝔘"} | {"gemeinsam" + a + b for a in "abcdefgh" for b in ("", "x", "y", "zz")}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    found = [(r.a, r.b) for r in spelling.near_pairs(frame, group_words=3).collect()]
    want = {(a, b) for a in words for b in words if a and b and (len(a), a) < (len(b), b) and len(b) - len(a) < 2 and one_edit(a, b)}
    assert len(found) == len(set(found)) and set(found) == want


def test_many_hot_chunks_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_SENT", 0)
    words = {a + "mitte" + b for a in "abcdef" for b in "abcdef"}
    found = {(r.a, r.b) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), group_words=2).collect()}
    assert found == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


# ---------------------------------------------------------------- templates
def test_template_statements_and_spans():
    t = Template("{% set k = 2 * 3 %}{% for m in messages %}{% if loop.first %}^{% elif m.n > k %}big{% else %}{{ m['n'] }}{% endif %}"
                 "{% generation %}<{{ m.text | trim | upper }}>{% endgeneration %}{{ '' if loop.last else ', ' }}{% endfor %}")
    assert t.streams
    assert t.render(iter([{"n": 1, "text": " a "}, {"n": 5, "text": "b"}, {"n": 9, "text": ""}])) == ("^<A>, 5<B>, big<>", [(1, 4), (7, 10), (15, 17)])
    assert t.render([]) == ("", [])
    held = Template("{{ messages | length }}{% for m in messages -%}  {{ m not in messages }} {%- endfor %}")
    assert not held.streams and held.render([1, 2])[0] == "2falsefalse"


def test_constants_are_folded():
    from strata.llm import templates as T

    def tree(source):
        return T.folded(T.parse(source), T.FILTERS)

    assert tree("a{{ 'b' | upper }}{{ 1 + 2 * 3 }}{% if 1 > 2 %}x{{ y }}{% else %}c{% endif %}{{ none }}d") == T.Block((T.Print(T.Const("aB7cd")),))
    assert tree("{{ x if 'a' in 'bac' and not false else y }}") == T.Block((T.Print(T.Name("x")),))
    assert tree("{{ '}}%}' ~ \"\\\"'\" }}") == T.Block((T.Print(T.Const("}}%}\"'")),))


@pytest.mark.parametrize("bad", ["{{ x.__class__ }}", "{{ 'a'.upper }}", "{{ messages.append }}", "{{ f(1) }}", "{{ 1 % 0 }}", "{% for c in 'ab' %}{% endfor %}", "{% if %}",
                                 "{% endif %}", "{% if 1 %}", "{{ 1 | no }}", "{{ 9999999 * 9999999 }}", "{{ 1 + 'a' }}", "{% import os %}", "{{ [] }}", "{{ }}", "{{ a b }}",
                                 "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{% else %}", "{{ unknown }}", "{{ messages[5] }}", "{{ messages }}"])
def test_sandbox_and_syntax_errors(bad):
    with pytest.raises(TemplateError):
        Template(bad).render([{"role": "user"}])


# ---------------------------------------------------------------- chat
SNIPPETS = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "s>", "/", "[", "INST]", " ", "\n", "é", "a"]), max_size=12).map("".join)


@settings(max_examples=300)
@given(SNIPPETS)
def test_escape_is_reversible(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROLS)


@settings(max_examples=300)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "</s>", "[ROLE]"]), SNIPPETS), max_size=6), st.integers(1, 30))
def test_any_turns_are_read_back_from_pieces(turns, most):
    t = Template(chat.TEMPLATE, {"escape": chat.escape})
    text, spans = t.render({"role": r, "text": x} for r, x in turns)
    parts = list(chat.pieces(t.parts({"role": r, "text": x} for r, x in turns), most))
    assert "".join(p for p, _ in parts) == text
    assert list(chat.turns_of(p for p, _ in parts)) == turns
    said = [x for r, x in turns if r == "assistant"]
    assert [chat.unescape(text[a:b]) for a, b in spans] == said
    assert "".join(chat.unescape(p[s["begin"] : s["end"]]) for p, some in parts for s in some) == "".join(said)


@pytest.mark.parametrize("piece_chars", [10, 1 << 20])
def test_conversations_equal_brute_force(spark, piece_chars):
    rng = random.Random(3)
    bits = [*chat.CONTROLS, "\\", " ok ", "é", "\n", ""]
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 0, 1, 2]), rng.choice(["user", "assistant", "system", None]),
             rng.choice([None, "".join(rng.choice(bits) for _ in range(5))])) for _ in range(60)]
    rows += [(9, k, "user" if k % 2 else "assistant", f"turn {k} " * 30) for k in range(400)] + [(9, 3, "user", "twice")] * 2  # a hot conversation
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("spans", F.lit("clash")).withColumn("a.b", F.lit(1))
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(chat.formatted(turns, piece_chars=piece_chars)).collect()}
    want = {}
    t = Template(chat.TEMPLATE, {"escape": chat.escape})
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        whole = t.render({"role": r[2] or "", "text": r[3] or ""} for r in mine)[0]
        want[c] = (len(mine), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)), len(loss), sha(loss), len(whole))
    assert got == want
    assert chat.read_back(chat.formatted(turns.limit(0))).count() == 0


def test_no_turn_is_an_error():
    with pytest.raises(ValueError):
        list(chat.turns_of(["[INST] a"]))


# ---------------------------------------------------------------- queries
def test_spelling_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in queries.op12_spelling(spark, SF001).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute_variants(brute_words(rows))


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op13_chat"])
def test_new_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF001)
    rel = con.sql(queries.ORACLE[name])
    at = [rel.columns.index(c) for c in df.columns]
    assert Counter(tuple(r) for r in df.collect()) == Counter(tuple(r[k] for k in at) for r in rel.fetchall())

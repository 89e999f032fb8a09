"""Spelling variants: words one edit apart, found by a join of asymmetric q-chunks.

Of two words one edit (an inserted, deleted or replaced code point) apart, the shorter one (of equal ones: each in turn) is cut into **two disjoint
chunks**, its halves; the edit can spoil only one of them. The other word contributes its **positional grams**. A chunk that is not spoiled
is a gram of the other word, at the same place or shifted by one, so a join of chunks and grams on (length, chunk, gram) within
shift one brings all pairs together, and each candidate is verified by its edit distance. Of all positional grams only those are
sent that such a shift can reach: of a word as long as the other nothing is shifted, and of a word longer by one the first chunk stays
where it is or the second moves by one.

A chunk that many words share (a frequent prefix or ending) would bring together as many pairs as its words squared. The join condition of such a
group is the same problem again: the words' *rests*, one edit apart. So the rests of words under hot chunks are cut into halves themselves, and
joined on both chunks, until the groups are small or a rest is a single code point, whose group is no larger than the alphabet allows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.rows import quoted
from strata.llm.store import kept
from strata.llm.texts import text_batches
from strata.operators.skew import salted_join

#: Runs of Latin letters: A-Z, a-z and U+00C0 to U+00FF.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Texts whose words are counted together before they leave a task.
COUNT_BYTES = 1 << 20
#: Different words a task's counter holds before it is sent on.
COUNT_WORDS = 200_000
#: Words that may share a chunk before their rests are cut too.
GROUP_WORDS = 64
#: Hot chunks that are sent to every task; more of them are joined by shuffle.
MOST_SENT = 50_000


def ascii_lower(text: str) -> str:
    """The text with only A-Z lower-cased."""
    return text.encode().lower().decode()  # of bytes: ASCII letters only


def noisy(run: str, doc_id, every: int) -> str:
    """The lower-cased run; of one in ``every`` (by crc32 of id and run) a code point is left out."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(docs: DataFrame, least_chars: int = 5, least_n: int = 3, drop_every: int | None = 97, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(word, n): the different words of all texts with at least ``least_chars`` code points and ``least_n`` occurrences. ``drop_every``:
    one in so many runs loses a code point first (simulated typing errors; None: none). Words are counted in the task before the
    shuffle, so a word that is everywhere leaves a task as a few rows. Null texts hold none."""
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("t"))

    def run(batches):
        counts: Counter[str] = Counter()

        def sent():
            some = [(w, n) for w, n in counts.items() if len(w) >= least_chars]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

        for part, texts in text_batches(batches, "t", COUNT_BYTES):
            for doc_id, text in zip(part.column(0).to_pylist(), texts):
                own = Counter(RUN.findall(ascii_lower(text)))
                if drop_every is None:
                    counts.update(own)
                else:
                    for word, n in own.items():
                        counts[noisy(word, doc_id, drop_every)] += n
                if len(counts) >= COUNT_WORDS:
                    yield sent()
                    counts.clear()
        yield sent()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def part(text: Column, begin, size) -> Column:
    """``size`` code points from ``begin`` (from 0)."""
    return F.substr(text, F.lit(begin) + 1 if isinstance(begin, int) else begin + 1, F.lit(size) if isinstance(size, int) else size)


def chunks(rows: DataFrame) -> DataFrame:
    """(key, word, rest) of the words' halves: the key names length, half and chunk, behind the chunks already shared; ``rest`` is the other half."""
    long = F.length("rest")
    half = F.expr("length(rest) div 2")
    first, second = part(F.col("rest"), 0, half), part(F.col("rest"), half, long)
    name = lambda mark, gram: F.concat("key", F.lit(" "), long.cast("string"), F.lit(mark), gram)
    return rows.select("word", F.explode(F.array(F.struct(name("<", first).alias("key"), second.alias("rest")),
                                                 F.struct(name(">", second).alias("key"), first.alias("rest")))).alias("x")).select("x.key", "word", "x.rest")


def grams(rows: DataFrame) -> DataFrame:
    """(key, word, rest) of the positional grams that a half of a word of the same length, or of one shorter by one, can be equal to."""
    long = F.length("rest")
    found = []
    for less in (0, 1):
        size = long - less  # of the word that is cut into halves
        half = F.expr(f"(length(rest) - {less}) div 2")
        name = lambda mark, gram, size=size: F.concat("key", F.lit(" "), size.cast("string"), F.lit(mark), gram)
        # the first half in its place; the second where the edit before it has moved it
        found.append(F.struct(name("<", part(F.col("rest"), 0, half)).alias("key"), part(F.col("rest"), half, long).alias("rest"), (size >= 1).alias("is")))
        found.append(F.struct(name(">", part(F.col("rest"), half + less, long)).alias("key"), part(F.col("rest"), 0, half + less).alias("rest"), (size >= 1).alias("is")))
    return rows.select("word", F.explode(F.filter(F.array(*found), lambda x: x["is"])).alias("x")).select("x.key", "word", "x.rest")


def near_pairs(vocabulary: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(a, b): words of ``vocabulary`` (distinct ``word``) one edit apart, each pair once: a is the shorter or, of equal length, the smaller
    one. Words hold no blanks, ``<`` or ``>``; null and empty ones are near to nothing."""
    rows = vocabulary.where("word <> ''").select(F.lit("").alias("key"), "word", F.col("word").alias("rest"))
    return _pairs(chunks(rows), grams(rows), group_words).distinct()


def _pairs(short: DataFrame, long: DataFrame, group_words: int) -> DataFrame:
    """Pairs that share a key, verified; an insertion where two chunks meet is found under both. All words under a key of ``short`` have rests of
    one length, and rests of one code point are as many as there are letters at most: those groups are joined as they are."""
    hot = short.groupBy("key").agg(F.count("*").alias("size"), F.max(F.length("rest")).alias("long")).where(
        (F.col("size") > group_words) & (F.col("long") > 1)).select("key", F.lit(True).alias("hot"))
    hot = kept(hot, "spelling_hot")
    n_hot = hot.count()
    deeper = None
    if n_hot:
        def marked(rows, purpose):  # the hot keys are at most the rows by ``group_words``; sent to all tasks only if they are few
            return kept(rows.join(F.broadcast(hot), "key", "left") if n_hot <= MOST_SENT else salted_join(rows, hot, ["key"], "left"), purpose)

        short, long = marked(short, "spelling_chunks"), marked(long, "spelling_grams")
        deeper = _pairs(chunks(short.where("hot")), grams(long.where("hot")), group_words)
        short, long = short.where("hot is null"), long.where("hot is null")
    a, b = short.select("key", F.col("word").alias("a")), long.select("key", F.col("word").alias("b"))
    ordered = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    found = a.join(b, "key").where(ordered & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")
    return found if deeper is None else found.unionByName(deeper)


def forms(vocabulary: DataFrame, pairs: DataFrame, times: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n) of every row of ``vocabulary`` (word, n): how many words are near, and of those the most frequent one (of
    equal ones the smallest in code-point order) if it occurs at least ``times`` times as often."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(pairs.select("b", "a"))
    counted = both.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    enough = -F.col("best.minus") >= times * F.col("n")
    return vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
                                                        F.when(enough, -F.col("best.minus")).alias("form_n"))


def roots(words: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last word on the way from form to form. A form is more frequent than its word, so there
    is no circle; every round doubles the steps, so the rounds grow with the logarithm of the longest way."""
    way = kept(words.where("form is not null").select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        on = way.select(F.col("word").alias("at"), F.col("root").alias("further"))
        step = way.join(on, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = kept(step, "spelling_roots")
        if step.where("moved").isEmpty():
            return way
        way = step.drop("moved")


def variants(docs: DataFrame, least_chars: int = 5, least_n: int = 3, drop_every: int | None = 97, times: int = 2, text_col: str = "text",
             id_col: str = "doc_id", group_words: int = GROUP_WORDS) -> DataFrame:
    """One row per word of the texts (``words``): word, form (the near word it is taken for, or null), root (from form to form the last one;
    the word itself if it has none), n, n_near (near words) and form_n. Other columns of ``docs`` are not read; an empty table gives none. A null id
    counts as an empty one; repeated rows count again."""
    vocabulary = kept(words(docs, least_chars, least_n, drop_every, text_col, id_col), "spelling_words")
    found = kept(forms(vocabulary, near_pairs(vocabulary, group_words), times), "spelling_forms")
    last = roots(found).select(F.col("word").alias("of"), "root")
    return found.join(last, F.col("word") == F.col("of"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Conversations as training text, by a compiled template, with a loss mask over what the assistant says, and back.

Control strings mark turns. Where one stands in what somebody says, a backslash behind its first character takes it apart, and backslashes are
doubled, so that an escaped text holds no control string and unescaping gives the very text.

Turns are sorted by conversation and turn by Spark and go through the template's closures as a stream: a task holds one turn and one piece of
output, however long a conversation is. The output of a conversation is one row, or several rows of about ``PIECE_CHARS``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.rows import quoted
from strata.llm.templates import BEGIN, END, Template

#: Control strings of the template below: they begin and end turns.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
TEMPLATE = """
{%- for m in messages -%}
{%- if m.role == 'user' -%}[INST] {{ m.text | escape }} [/INST]
{%- elif m.role == 'assistant' -%}<s>{% generation %}{{ m.text | escape }}{% endgeneration %}</s>
{%- else -%}[ROLE] {{ m.role | escape }} [/ROLE]{{ m.text | escape }}</s>
{%- endif -%}
{%- endfor -%}
"""
#: A turn as the template writes it.
TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|\[ROLE\] (?P<role>.*?) \[/ROLE\](?P<other>.*?)</s>", re.S)
PIECE_CHARS = 1 << 20
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """The text without control strings; ``unescape`` undoes it. Controls neither overlap each other nor hold a backslash."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def sorted_groups(batches, key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """(key, rows) of rows that are sorted by key, as streams: the rows of a group have to be taken before the next group is asked for."""
    rows = (r for b in batches for part in (b.slice(k, 1024) for k in range(0, b.num_rows, 1024)) for r in part.to_pylist())
    ahead = next(rows, None)

    def group(of):
        nonlocal ahead
        while ahead is not None and ahead[key] == of:
            now, ahead = ahead, next(rows, None)
            yield now

    while ahead is not None:
        of = ahead[key]
        some = group(of)
        yield of, some
        for _ in some:  # whatever a template didn't use
            pass


def pieces(parts: Iterable, most: int = PIECE_CHARS) -> Iterator[tuple[str, list[dict]]]:
    """(text, spans) of a rendered stream, cut behind a part when ``most`` characters are there; spans count code points of the piece. A
    stream without text is one empty piece."""
    out, spans, at, begin, first = [], [], 0, None, True
    for p in parts:
        if p is BEGIN:
            begin = at
        elif p is END:
            spans.append({"begin": begin, "end": at})
            begin = None
        else:
            out.append(p)
            at += len(p)
        if at >= most:
            if begin is not None:
                spans.append({"begin": begin, "end": at})
            yield "".join(out), spans
            out, spans, at, first = [], [], 0, False
            begin = None if begin is None else 0
    if first or at:
        yield "".join(out), spans


def formatted(turns: DataFrame, template: str = TEMPLATE, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """(conv_id, piece, text, spans) from (conv_id, turn, role, text): a conversation's turns through the template, in the order of turn, then
    role, then text (nulls first, repeated rows all count). A null text or role is empty; rows without conv_id are one conversation.
    ``spans`` (begin, end) mark what is to be learnt, in code points of the piece. Pieces of a conversation follow each other, from 0.
    Other columns are not read. An empty table gives no rows. One shuffle of the turns. The turns of a conversation pass through one task in
    order, as a stream; nothing holds them together."""
    rows = turns.select(*[F.col(quoted(c)).alias(c) for c in ("conv_id", "turn")], F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = rows.select("conv_id").schema.add("piece", "long").add("text", "string").add("spans", T.ArrayType(T.StructType().add("begin", "long").add("end", "long")))

    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        types = pa.schema([first.schema.field("conv_id"), ("piece", pa.int64()), ("text", pa.string()),
                           ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])
        compiled = Template(template, {"escape": escape})
        out, size = [], 0
        for conv_id, messages in sorted_groups(chain([first], batches), "conv_id"):
            for k, (text, spans) in enumerate(pieces(compiled.parts(messages), piece_chars)):
                out.append({"conv_id": conv_id, "piece": k, "text": text, "spans": spans})
                size += len(text)
                if size >= piece_chars:
                    yield pa.RecordBatch.from_pylist(out, schema=types)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=types)

    return rows.mapInArrow(run, schema)


def turns_of(texts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a conversation from its pieces; a turn may go on in the next piece. Raises ValueError at what is no turn."""
    rest = ""
    for text in texts:
        rest += text
        at = 0
        while m := TURN.match(rest, at):
            at = m.end()
            kind = m.lastgroup if m.lastgroup != "other" else None
            yield (kind, unescape(m[kind])) if kind else (unescape(m["role"]), unescape(m["other"]))
        rest = rest[at:]
    if rest:
        raise ValueError("a conversation ends in the middle of a turn")


def read_back(output: DataFrame) -> DataFrame:
    """One row per conversation of what ``formatted`` gave (its rows in its order): conv_id, n_turns, turns_sha256 (of role, line feed, text, line feed of
    each turn), loss_chars and loss_sha256 (code points and digest of the unescaped text under the spans) and formatted_chars. Turns are
    read from the text, what is learnt from text and spans. Digests are fed piece by piece."""
    schema = output.select("conv_id").schema
    for name, kind in (("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"), ("loss_sha256", "string"), ("formatted_chars", "long")):
        schema = schema.add(name, kind)

    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        types = pa.schema([first.schema.field("conv_id"), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                           ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        out = []
        for conv_id, rows in sorted_groups(chain([first], batches), "conv_id"):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            sums = {"n": 0, "chars": 0, "loss": 0}

            def texts(rows=rows, loss=loss, sums=sums):
                for r in rows:
                    sums["chars"] += len(r["text"])
                    for s in r["spans"]:
                        learnt = unescape(r["text"][s["begin"] : s["end"]])
                        sums["loss"] += len(learnt)
                        loss.update(learnt.encode())
                    yield r["text"]

            for role, text in turns_of(texts()):
                sums["n"] += 1
                turns.update(f"{role}\n{text}\n".encode())
            out.append({"conv_id": conv_id, "n_turns": sums["n"], "turns_sha256": turns.hexdigest(), "loss_chars": sums["loss"],
                        "loss_sha256": loss.hexdigest(), "formatted_chars": sums["chars"]})
            if len(out) == 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=types)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=types)

    return output.mapInArrow(run, schema)

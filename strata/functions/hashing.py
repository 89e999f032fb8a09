"""Record hashes and deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# JSON text of a record: compact, NULL fields kept, timestamps as
# 'yyyy-MM-dd HH:mm:ss' so the bytes agree with SQL engines' to_json.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
}


def record_json(cols, sort_keys: bool = False) -> Column:
    names = sorted(cols) if sort_keys else list(cols)
    return F.to_json(F.struct(*[F.col(c) for c in names]), JSON_OPTIONS)


def sha256_record_hash(cols) -> Column:
    """SHA-256 hex of the record's JSON with keys sorted."""
    return F.sha2(record_json(cols, sort_keys=True), 256)


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def md5_record_hash(cols) -> Column:
    """MD5 hex of the values as text, table order, joined by '|'.

    NULL is written 'None' (concat_ws would otherwise skip it and shift the
    remaining fields).
    """
    return F.md5(F.concat_ws("|", *[_text(c) for c in cols]))


def uuid_from_md5(*parts) -> Column:
    """Deterministic UUID-shaped key: md5 of the parts, each behind its length, NULL as a mark of its own, so that different parts never
    give one text.

    Unlike uuid(), a retried task or a second action produces the same key,
    so the two sinks of one validation pass always agree.
    """
    texts = [(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts]
    h = F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))

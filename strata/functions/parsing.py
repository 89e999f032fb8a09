"""Parsing with Python-compatible acceptance, as pure Column expressions.

Spark's casts accept inputs that the pipeline's contract rejects (and vice
versa), so every cast is guarded by a regular expression first and then
done with ``try_cast`` (ANSI mode never raises inside a rule).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Acceptance patterns of the contract.
# integer (after stripping whitespace): optional sign, ASCII digits only.
INT_PATTERN = r"^[+-]?[0-9]+$"
# ISO date or date-time: date, optional T/space time with optional minutes,
# seconds, 1-6 fraction digits, and an optional Z or +hh:mm offset.
ISO_DATETIME_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
)
# what follows the time of day
OFFSET_PATTERN = r"(Z|[+-][0-9]{2}:[0-9]{2})$"
# Python's str.strip() removes every character for which str.isspace() holds
# (ASCII controls \t..\r and \x1c..\x1f, NEL, NBSP and the Unicode space
# separators), SQL trim only spaces. The set is derived from that rule.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
# Literals accepted as booleans (compared lower-cased, not stripped).
TRUE_WORDS = ("true", "1", "yes", "t")
FALSE_WORDS = ("false", "0", "no", "f")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove all leading and trailing whitespace, as str.strip() does
    (btrim over a character set: no regular expression per row)."""
    return F.btrim(col_(c), F.lit(PY_WHITESPACE))


def is_falsy(c) -> Column:
    """NULL or the empty string (but not '0' or ' ')."""
    c = col_(c)
    return c.isNull() | (c.cast("string") == F.lit(""))


def parse_int(c) -> Column:
    """String -> bigint, NULL when the stripped text is not a whole number."""
    s = strip_ws(col_(c).cast("string"))
    return F.when(s.rlike(INT_PATTERN), s.try_cast("bigint"))


def parse_iso_datetime(c) -> Column:
    """ISO-8601 text -> timestamp_ntz, else NULL. A text with an offset (or
    Z) names an instant and gives its UTC wall clock; one without is taken
    as UTC already."""
    c = col_(c).cast("string")
    ok = c.rlike(ISO_DATETIME_PATTERN) & ~c.startswith("0000")
    wall = F.regexp_replace(c, OFFSET_PATTERN, "").try_cast("timestamp_ntz")
    offset = F.regexp_extract(c, OFFSET_PATTERN, 0)
    sign = F.when(offset.startswith("-"), -1).otherwise(1)
    minutes = sign * (F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 5, 2).try_cast("int"))
    utc = F.timestamp_add("MINUTE", F.coalesce(-minutes, F.lit(0)), wall)
    return F.when(ok, F.when((offset == "") | (offset == "Z"), wall).otherwise(utc))


def parse_bool_like(c) -> Column:
    """true/1/yes/t -> True, false/0/no/f -> False (any case), else NULL."""
    low = F.lower(col_(c).cast("string"))
    return F.when(low.isin(*TRUE_WORDS), F.lit(True)).when(low.isin(*FALSE_WORDS), F.lit(False))

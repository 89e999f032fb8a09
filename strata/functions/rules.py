"""Validation rules as Column expressions.

A rule yields two columns: ``error`` — NULL when the value passes, else a
struct (category, message, failed_field, expected_value, actual_value) —
and ``value``, the cleaned/typed value. A rule set is an ordered list; the
first failing rule decides the row's error (``first_failure``), exactly like
an early ``return`` in a row loop, but evaluated as one projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .parsing import is_falsy, parse_bool_like, parse_int, parse_iso_datetime, strip_ws

# Error categories.
MISSING_FIELD = "MISSING_FIELD"
DATA_TYPE = "DATA_TYPE"
BUSINESS_RULE = "BUSINESS_RULE"

# Fixed value: an '@', then a '.' before any second '@'.
EMAIL_PATTERN = r"^[^@]*@[^@]*\."

ERROR_FIELDS = ("category", "message", "failed_field", "expected_value", "actual_value")


def _lit_or(v) -> Column:
    if v is None:
        return F.lit(None).cast("string")
    return v.cast("string") if isinstance(v, Column) else F.lit(str(v))


def error(category: str, message, field: str, actual=None, expected=None) -> Column:
    return F.struct(
        F.lit(category).alias("category"),
        _lit_or(message).alias("message"),
        F.lit(field).alias("failed_field"),
        _lit_or(expected).alias("expected_value"),
        _lit_or(actual).alias("actual_value"),
    )


@dataclass
class Rule:
    field: str
    error: Column          # NULL = passes
    value: Column | None   # cleaned value (None = rule only checks)
    out_type: str | None = None


def _raw_text(field: str) -> Column:
    return F.col(field).cast("string")


def required_int(field: str) -> Rule:
    raw = _raw_text(field)
    parsed = parse_int(raw)
    err = (F.when(is_falsy(raw), error(MISSING_FIELD, f"{field} is required but missing", field))
           .when(parsed.isNull(), error(DATA_TYPE, F.concat(F.lit(f"{field} must be integer, got: "), raw),
                                        field, actual=raw)))
    return Rule(field, err, parsed, "bigint")


def optional_int(field: str) -> Rule:
    raw = _raw_text(field)
    parsed = parse_int(raw)
    err = F.when(~is_falsy(raw) & parsed.isNull(),
                 error(DATA_TYPE, F.concat(F.lit(f"{field} must be integer, got: "), raw), field, actual=raw))
    return Rule(field, err, F.when(~is_falsy(raw), parsed), "bigint")


def required_string(field: str, max_len: int = 100, shown: int = 50) -> Rule:
    raw = _raw_text(field)
    clean = strip_ws(raw)
    shown_value = F.when(F.length(clean) > shown, F.concat(F.substring(clean, 1, shown), F.lit("...")))\
        .otherwise(clean)
    err = (F.when(is_falsy(raw), error(MISSING_FIELD, f"{field} is required but missing", field))
           .when(F.length(clean) > max_len,
                 error(BUSINESS_RULE, f"{field} exceeds {max_len} character limit", field, actual=shown_value)))
    return Rule(field, err, clean, "string")


def email(field: str = "email") -> Rule:
    raw = _raw_text(field)
    clean = F.lower(strip_ws(raw))
    # '@' present and a '.' in the piece between the first and second '@'
    well_formed = clean.rlike(EMAIL_PATTERN)
    err = (F.when(is_falsy(raw), error(MISSING_FIELD, f"{field} is required but missing", field))
           .when(~well_formed, error(BUSINESS_RULE, f"{field} format is invalid", field, actual=clean)))
    return Rule(field, err, clean, "string")


def bool_like(field: str, default: bool = True) -> Rule:
    raw = _raw_text(field)
    parsed = parse_bool_like(raw)
    err = F.when(raw.isNotNull() & parsed.isNull(),
                 error(DATA_TYPE, F.concat(F.lit(f"{field} must be boolean-like, got: "), raw), field, actual=raw))
    return Rule(field, err, F.coalesce(parsed, F.lit(default)), "boolean")


def iso_datetime(field: str) -> Rule:
    raw = _raw_text(field)
    parsed = parse_iso_datetime(raw)
    err = F.when(~is_falsy(raw) & parsed.isNull(),
                 error(DATA_TYPE, f"{field} is not a valid datetime", field, actual=raw))
    return Rule(field, err, F.when(~is_falsy(raw), parsed), "timestamp_ntz")


def flag01(field: str, default: int = 1) -> Rule:
    raw = _raw_text(field)
    parsed = parse_int(raw)
    err = (F.when(raw.isNotNull() & parsed.isNull(),
                  error(DATA_TYPE, F.concat(F.lit(f"{field} must be integer, got: "), raw), field, actual=raw))
           .when(raw.isNotNull() & ~parsed.isin(0, 1),
                 error(BUSINESS_RULE, f"{field} must be 0 or 1", field, actual=raw)))
    return Rule(field, err, F.coalesce(parsed, F.lit(default).cast("bigint")), "bigint")


# Generic rules for typed inputs (used to show the promoter is not customer-specific).
def in_domain(field: str, values) -> Rule:
    c = F.col(field)
    err = (F.when(c.isNull(), error(MISSING_FIELD, f"{field} is required but missing", field))
           .when(~c.isin(*values), error(BUSINESS_RULE, f"{field} must be one of {','.join(values)}", field,
                                         actual=c, expected=",".join(values))))
    return Rule(field, err, c)


def positive(field: str) -> Rule:
    c = F.col(field)
    err = (F.when(c.isNull(), error(MISSING_FIELD, f"{field} is required but missing", field))
           .when(c <= 0, error(BUSINESS_RULE, f"{field} must be positive", field, actual=c, expected="> 0")))
    return Rule(field, err, c)


def date_between(field: str, lo: str, hi: str) -> Rule:
    c = F.col(field)
    d = F.to_date(c)
    err = (F.when(c.isNull(), error(MISSING_FIELD, f"{field} is required but missing", field))
           .when((d < F.lit(lo).cast("date")) | (d > F.lit(hi).cast("date")),
                 error(BUSINESS_RULE, f"{field} outside {lo}..{hi}", field, actual=c, expected=f"{lo}..{hi}")))
    return Rule(field, err, c)


def first_failure(rules) -> Column:
    """The error of the first failing rule, or NULL when all pass."""
    return F.coalesce(*[r.error for r in rules])


_CACHE: dict = {}


def _memo(name: str, build):
    """Rule Columns are unresolved expressions, reusable by every DataFrame
    of the same application; building them costs one JVM call per function,
    so each rule set is built once per application."""
    from pyspark import SparkContext
    key = (name, SparkContext._active_spark_context.applicationId)
    if key not in _CACHE:
        _CACHE[key] = build()
    return list(_CACHE[key])


def customer_rules() -> list[Rule]:
    """The silver customer rule set; field order is the semantics."""
    return _memo("customer", _customer_rules)


def _customer_rules() -> list[Rule]:
    return [
        required_int("customer_id"),
        required_int("store_id"),
        required_string("first_name"),
        required_string("last_name"),
        email("email"),
        optional_int("address_id"),
        bool_like("activebool"),
        iso_datetime("create_date"),
        iso_datetime("last_update"),
        flag01("active"),
    ]


def orders_rules() -> list[Rule]:
    """A second rule set, over typed orders."""
    return _memo("orders", _orders_rules)


def _orders_rules() -> list[Rule]:
    return [
        in_domain("o_orderstatus", ("F", "O", "P")),
        positive("o_totalprice"),
        date_between("o_orderdate", "1995-01-01", "2000-12-31"),
    ]

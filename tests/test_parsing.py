"""Validator edge values; expectations follow Python's int()/fromisoformat()/
str.strip() semantics, or the documented deviations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions import rules as R
from strata.functions.parsing import parse_bool_like, parse_int, parse_iso_datetime, strip_ws


def _one(spark, values, expr_fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr_fn(F.col("v"))).collect()]


INT_OK = {"12": 12, " 12 ": 12, "+5": 5, "-3": -3, "99999999999": 99999999999, "\t7\n": 7}
INT_BAD = ["", "12.0", "1e3", "abc", "12L", "1_000", "١٢"]


def test_parse_int(spark):
    assert _one(spark, list(INT_OK), parse_int) == list(INT_OK.values())
    assert _one(spark, INT_BAD, parse_int) == [None] * len(INT_BAD)


TS_OK = {
    "2022-02-14": dt.datetime(2022, 2, 14),
    "2022-02-14T00:00:00Z": dt.datetime(2022, 2, 14),
    "2022-02-14 09:57": dt.datetime(2022, 2, 14, 9, 57),
    "2022-02-14 09:57:20.1": dt.datetime(2022, 2, 14, 9, 57, 20, 100000),
    "2022-02-14T09:57:20+05:30": dt.datetime(2022, 2, 14, 4, 27, 20),  # wall clock kept
}
TS_BAD = ["2022", "2022-02", "2022-2-4", "09:57", "2022-02-30", "2022-02-14 24:00:00", "NaT", "0000-01-01",
          "20220214", "2022-W07-1", "2022-02-14T09:57:20.123456789", "2022-02-14Z"]


def test_parse_iso_datetime(spark):
    assert _one(spark, list(TS_OK), parse_iso_datetime) == list(TS_OK.values())
    assert _one(spark, TS_BAD, parse_iso_datetime) == [None] * len(TS_BAD)


def test_bool_like(spark):
    vals = ["true", "1", "YES", "t", "False", "0", "no", "F", "maybe", "", " true"]
    assert _one(spark, vals, parse_bool_like) == [True] * 4 + [False] * 4 + [None] * 3


def test_strip_all_whitespace(spark):
    assert _one(spark, ["\t a \n", "   ", "b"], strip_ws) == ["a", "", "b"]


def _rule(spark, rule, values):
    df = spark.createDataFrame([(v,) for v in values], f"{rule.field} string")
    return [(r["c"], r["v"]) for r in df.select(rule.error["category"].alias("c"), rule.value.alias("v")).collect()]


def test_email_rule(spark):
    out = _rule(spark, R.email("email"), ["A@B.c", " a@b.com ", None, "", "x", "a@b", "a@b@c.com"])
    assert out[0] == (None, "a@b.c") and out[1] == (None, "a@b.com")
    assert [c for c, _ in out[2:]] == ["MISSING_FIELD", "MISSING_FIELD", "BUSINESS_RULE", "BUSINESS_RULE",
                                        "BUSINESS_RULE"]


def test_required_string_rule(spark):
    out = _rule(spark, R.required_string("first_name"), ["Ann", " Ann ", "   ", None, "", "N" * 101])
    assert out[:3] == [(None, "Ann"), (None, "Ann"), (None, "")]
    assert [c for c, _ in out[3:]] == ["MISSING_FIELD", "MISSING_FIELD", "BUSINESS_RULE"]


def test_required_string_shows_50_chars(spark):
    df = spark.createDataFrame([("N" * 101,)], "first_name string")
    r = R.required_string("first_name")
    assert df.select(r.error["actual_value"]).first()[0] == "N" * 50 + "..."


def test_flag_rule(spark):
    out = _rule(spark, R.flag01("active"), ["0", "1", None, "2", "one"])
    assert out[:3] == [(None, 0), (None, 1), (None, 1)]
    assert [c for c, _ in out[3:]] == ["BUSINESS_RULE", "DATA_TYPE"]


def test_required_int_messages(spark):
    df = spark.createDataFrame([("X7",), (None,)], "customer_id string")
    r = R.required_int("customer_id")
    rows = df.select(r.error["message"].alias("m"), r.error["actual_value"].alias("a")).collect()
    assert rows[0]["m"] == "customer_id must be integer, got: X7" and rows[0]["a"] == "X7"
    assert rows[1]["m"] == "customer_id is required but missing" and rows[1]["a"] is None


def test_optional_int_and_bool_defaults(spark):
    assert _rule(spark, R.optional_int("address_id"), [None, "", "5", "abc"]) == \
        [(None, None), (None, None), (None, 5), ("DATA_TYPE", None)]
    assert _rule(spark, R.bool_like("activebool"), [None, "f", "maybe"]) == \
        [(None, True), (None, False), ("DATA_TYPE", True)]


@pytest.mark.parametrize("value,expected", [("2022-02-15T09:57:20Z", None), ("2022-02-30", "DATA_TYPE"),
                                            ("", None), (None, None)])
def test_iso_rule(spark, value, expected):
    assert _rule(spark, R.iso_datetime("create_date"), [value])[0][0] == expected


def test_strip_matches_python_unicode_whitespace(spark):
    vals = ["　x ", "\x1cy\x85", "  z  "]
    assert _one(spark, vals, strip_ws) == [v.strip() for v in vals]
    assert _one(spark, [" 12 "], parse_int) == [12]

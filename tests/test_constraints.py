"""Set rules of a bronze batch against a plain loop, with a hot key and equal rows."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import constraints as CON, dlq as DLQ
from strata.session import scratch_dir


def _classes(spark, rows, stored, parents, max_key_rows):
    batch = spark.createDataFrame(rows, "k string, p string, v string").repartition(5)
    landed = CON.land(batch, scratch_dir(spark, "landed"), "b1")
    checked = landed.withColumn(DLQ.DLQ_ERR, F.when(F.col("v") == "bad", CON.error("ValueError", F.lit("v"))))
    rules = [CON.MaxLength("v", 3), CON.Unique(["k"], spark.createDataFrame(stored, "k string")), CON.Parent("p", spark.createDataFrame(parents, "id int"), "id")]
    out = CON.apply(checked, rules, max_key_rows)
    return sorted(((r.k or "", r.p or "", r.v or "", r._dlq.error_type if r._dlq else "", r._dlq.error_message if r._dlq else "") for r in out.collect()))


@pytest.mark.parametrize("max_key_rows", [50, 1_000_000])
def test_set_rules_equal_a_plain_loop(spark, max_key_rows):
    rng = random.Random(2)
    rows = [(rng.choice([None, "hot", "hot", str(rng.randrange(300))]), "7", "ok") for _ in range(900)]
    rows += [(f"x{k}", rng.choice([None, "1", "2", "3", "hot"]), rng.choice(["ok", "bad", "long text", None])) for k in range(300)]
    rows += [("same", "1", "ok")] * 200
    rng.shuffle(rows)
    stored, parents = [("5",), ("6",), (None,), ("x3",)], [(1,), (2,), (2,), (7,), (None,)]
    got = _classes(spark, rows, stored, parents, max_key_rows)
    want, seen = [], set()
    for k, p, v in sorted(rows, key=repr):      # rows of one key differ in nothing that a later rule sees
        e = ("", "")
        if v == "bad":
            e = ("SCHEMA_VALIDATION", "v")
        elif v and len(v) > 3:
            e = ("CONSTRAINT_VIOLATION", "value too long for v, at most 3")
        elif k is not None and (k,) in stored:
            e = ("CONSTRAINT_VIOLATION", f"key is stored already: k={k}")
        elif k is not None and k in seen:
            e = ("CONSTRAINT_VIOLATION", f"duplicate key: k={k}")
        else:
            seen.add(k)
            if p == "3" or p == "hot":
                e = ("CONSTRAINT_VIOLATION", f"no parent for p={p}")
            elif p == "2":
                e = ("UNKNOWN_ERROR", f"several parents for p={p}")
        want.append((k or "", p or "", v or "", *e))
    assert got == sorted(want)


def test_an_empty_batch_breaks_nothing(spark):
    assert _classes(spark, [], [], [], 10) == []


def test_classes_of_a_batch_come_from_its_data(spark):
    from strata.plans.registry import QUERIES

    from .conftest import SF001
    assert {r.error_type for r in QUERIES["dlq_classify"](spark, SF001).select("error_type").distinct().collect()} == {
        "SCHEMA_VALIDATION", "CONSTRAINT_VIOLATION", "UNKNOWN_ERROR"}

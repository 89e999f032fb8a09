"""Driver contract and the oracle comparison at sf0.001."""

import datetime as dt
import decimal
import re

import duckdb
import pytest

import __spark_entry__ as E
from strata.contracts import DRIVER_TABLES

from .conftest import SF001


def test_entry_kpi_row(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0].total_customers > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want
    # no pairwise joins and no Python evaluation anywhere in the plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)
    assert not _single_task_steps(plan), (name, _single_task_steps(plan))


def _single_task_steps(plan: str) -> list[str]:
    """Steps that funnel data-sized input through one task: a global sort
    (range shuffle) or a single-partition exchange that is not above a
    partial aggregate (e.g. a window without partition keys)."""
    out = ["global sort"] if "rangepartitioning" in plan else []
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        # a reused exchange has no child here: the next line belongs to its sibling
        if "Exchange SinglePartition" in line and "ReusedExchange" not in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            if not re.search(r"(Hash|ObjectHash|Sort)Aggregate\(keys=\[\]", child):
                out.append(child.strip()[:80])
    return out


def test_single_task_detector_passes_over_reused_exchanges():
    reused = """Union
:- *(9) HashAggregate(keys=[], functions=[sum(n#1)])
:  +- ReusedExchange [partial#2], Exchange SinglePartition, ENSURE_REQUIREMENTS, [plan_id=7]
+- *(3) Project [a#1]"""
    assert not _single_task_steps(reused)
    assert _single_task_steps(reused.replace("ReusedExchange [partial#2], ", "")) == ["+- *(3) Project [a#1]"]


def test_single_task_detector(spark):
    from pyspark.sql import Window, functions as F
    bad = [spark.range(100).orderBy(F.col("id").desc()),
           spark.range(100).withColumn("rn", F.row_number().over(Window.orderBy("id")))]
    good = [spark.range(100).agg(F.count("*")),
            spark.range(100).withColumn("rn", F.row_number().over(Window.partitionBy(F.col("id") % 3).orderBy("id")))]
    for df, expect in [(d, True) for d in bad] + [(d, False) for d in good]:
        df.collect()
        assert bool(_single_task_steps(df._jdf.queryExecution().executedPlan().toString())) == expect

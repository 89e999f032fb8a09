"""Invariants of the bronze -> silver -> gold flow."""

from collections import Counter

from pyspark.sql import functions as F

from strata import contracts as C
from strata.functions.rules import customer_rules
from strata.operators import quarantine as QR, silver as S
from strata.plans.medallion import CustomerFlow, run_medallion

from .conftest import SF001, SF01

# First failing rule per row of the dirty view at sf0.01.
EXPECTED_SF01 = {
    ("MISSING_FIELD", "customer_id"): 16, ("DATA_TYPE", "customer_id"): 16, ("DATA_TYPE", "store_id"): 17,
    ("MISSING_FIELD", "first_name"): 20, ("BUSINESS_RULE", "first_name"): 18, ("MISSING_FIELD", "last_name"): 19,
    ("MISSING_FIELD", "email"): 22, ("BUSINESS_RULE", "email"): 44, ("DATA_TYPE", "address_id"): 25,
    ("DATA_TYPE", "activebool"): 28, ("DATA_TYPE", "create_date"): 60, ("DATA_TYPE", "active"): 40,
    ("BUSINESS_RULE", "active"): 31,
}


def test_first_failure_counts_sf01(spark):
    v = CustomerFlow(spark, SF01).validated()
    rows = v.select(F.col("_err.category").alias("c"), F.col("_err.failed_field").alias("f")).collect()
    got = Counter((r.c, r.f) for r in rows if r.c is not None)
    assert dict(got) == EXPECTED_SF01
    assert sum(1 for r in rows if r.c is None) == 1144


def test_promoted_plus_quarantined_equals_input(spark):
    flow = CustomerFlow(spark, SF001)
    v = flow.validated()
    n_in = flow.source().count()
    assert flow.silver(v).count() + flow.quarantine(v).count() == n_in


def test_keys_are_deterministic(spark):
    flow = CustomerFlow(spark, SF001)
    a = sorted(r[0] for r in flow.silver().select("sl_customer_key").collect())
    b = sorted(r[0] for r in flow.silver().select("sl_customer_key").collect())
    assert a == b and len(set(a)) == len(a)


def test_rerun_same_batch_is_idempotent(spark, tmp_path):
    lake = str(tmp_path / "lake")
    first = run_medallion(spark, SF001, lake)
    again = run_medallion(spark, SF001, lake)
    assert first["rows"] == again["rows"]
    for name, path in first["paths"].items():
        assert spark.read.parquet(path).count() == first["rows"][name], name
    run_medallion(spark, SF001, lake, batch_id="batch_002")
    assert spark.read.parquet(first["paths"]["sl_customer"]).count() == 2 * first["rows"]["sl_customer"]


def test_replay_without_fixes_promotes_nothing(spark):
    q = CustomerFlow(spark, SF01).quarantine()
    updated, promoted = QR.replay(q, list(C.CUSTOMER_FIELDS), {}, customer_rules(), C.NEXT_LOAD_TS)
    assert promoted.count() == 0
    r = updated.agg(F.count_if(F.col("remediation_status") == "PENDING").alias("p"),
                    F.min("retry_count").alias("rc")).first()
    assert r.p == q.count() and r.rc == 1


def test_replay_with_fixes_resolves_some(spark):
    q = CustomerFlow(spark, SF01).quarantine()
    updated, promoted = QR.replay(q, list(C.CUSTOMER_FIELDS), QR.default_fixes(), customer_rules(), C.NEXT_LOAD_TS)
    resolved = updated.filter(F.col("remediation_status") == "RESOLVED").count()
    assert resolved > 0 and promoted.count() == resolved


def test_kpi_on_empty_dimension_is_zero(spark):
    flow = CustomerFlow(spark, SF001)
    empty = flow.dim_customer().limit(0)
    r = flow.kpi(empty).first()
    assert r.total_customers == 0 and r.active_customer_rate == 0.0 and r.premium_customer_rate == 0.0


def test_stats_match_counts(spark):
    flow = CustomerFlow(spark, SF01)
    s = S.promotion_stats(flow.validated(), "sl_customer").first()
    assert (s.records_processed, s.records_promoted, s.records_quarantined) == (1500, 1144, 356)
    assert abs(s.success_rate - 1144 / 1500 * 100) < 1e-9

"""Writing jobs: DLQ ingest, silver promotion, catalog sinks."""

from strata.functions.rules import customer_rules, orders_rules
from strata.operators import bronze as B, catalog as CAT
from strata.plans import runs as RUN
from strata.plans.fixtures import dirty_customers
from strata.plans.medallion import CustomerFlow
from strata.sources import sinks

from .conftest import SF001


def test_ingest_with_dlq_counts_and_rerun(spark, tmp_path):
    lake = str(tmp_path)
    s1 = RUN.ingest_with_dlq(spark, dirty_customers(spark, SF001), "customer", lake).first()
    s2 = RUN.ingest_with_dlq(spark, dirty_customers(spark, SF001), "customer", lake).first()
    assert s1 == s2 and s1.records_processed == 150 and s1.records_failed > 0
    assert spark.read.parquet(f"{lake}/staging/br_customer").count() == s1.records_success
    assert spark.read.parquet(f"{lake}/staging/br_ingestion_errors").count() == s1.records_failed


def test_promote_to_silver_customer_and_orders(spark, tmp_path):
    lake = str(tmp_path)
    flow = CustomerFlow(spark, SF001)
    res = RUN.promote_to_silver(spark, B_current(flow), customer_rules(), "br_customer_key", lake, "sl_customer",
                                record_cols=None)
    assert res["success"] and res["clean_records"] + res["quarantined_records"] == 150
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    res2 = RUN.promote_to_silver(spark, orders, orders_rules(), "o_orderkey", lake, "sl_orders",
                                 passthrough=("o_orderkey", "o_custkey"))
    assert res2["success"] and res2["quarantined_records"] > 0
    empty = RUN.promote_to_silver(spark, orders.limit(0), orders_rules(), "o_orderkey", lake, "sl_orders")
    assert empty == {"success": False, "records": 0, "error": "No records found"}


def B_current(flow):
    from strata.operators import silver as S
    return S.current_rows(flow.bronze())


def test_catalog_sink_and_listing(spark, tmp_path):
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    n = sinks.write_catalog_table(B.audit_sqlserver(nation, "dbo", "nation", "2024-01-01 00:00:00"),
                                  "dbo_nation", "bronze_test", "replace", schema_location=str(tmp_path / "bronze_test"))
    assert n == 25
    names = [r.table_name for r in CAT.catalog_tables(spark, "bronze_test").collect()]
    assert "dbo_nation" in names
    try:
        sinks.write_catalog_table(nation, "dbo_nation", "bronze_test", "fail")
        raised = False
    except Exception:
        raised = True
    assert raised
    assert spark.table("bronze_test.dbo_nation").count() == 25


def test_ingest_all_dry_run_honours_exclude(spark, tmp_path):
    audit = RUN.RunAudit("parquet", "b")
    names = RUN.ingest_all(spark, SF001, RUN.parquet_reader(spark, SF001), str(tmp_path), "2024-01-01 00:00:00",
                           audit, include="^(customer|orders|nation)$", exclude="^nation$", dry_run=True)
    assert names == ["customer", "orders"] and audit.entries == []


def test_target_naming_and_qualified_names():
    spec = RUN.TableSpec.parse("sales.Customer")
    assert (spec.source_schema, spec.source_table, spec.target()) == ("sales", "Customer", "sales_Customer")
    assert RUN.TableSpec.parse("Customer").source_schema == "dbo"
    assert B.target_name("br_{table}", table="film") == "br_film"


def test_bucketed_history_joins_without_shuffle(spark, tmp_path):
    from strata import contracts as C
    from strata.operators import history as H
    from strata.plans import fixtures as FX
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hist = H.scd2_initial(FX.customer_snapshot_1(spark, SF001), ["c_custkey"], C.LOAD_TS, C.BATCH_ID)
        for name in ("hist_a", "hist_b"):
            sinks.write_catalog_table(hist, name, "history_test", "replace", bucket_by=(8, "c_custkey"),
                                      schema_location=str(tmp_path / "history_test"))
        a, b = spark.table("history_test.hist_a"), spark.table("history_test.hist_b")
        plan = a.join(b, "c_custkey")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

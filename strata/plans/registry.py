"""Registered queries: one DataFrame-returning callable per operator.

Each takes (spark, sf_dir), reads the driver tables under ``sf_dir`` whole
(or data Spark derives from them) and returns a DataFrame. Most are lazy;
the sink, run and streaming queries perform their writes when called and
return what they wrote, read back. Only metadata-sized values (a watermark
scalar, table names) are ever collected to the driver.
"""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions import rules as R
from ..functions.hashing import md5_record_hash, sha256_record_hash, uuid_from_md5
from ..operators import bronze as B, catalog as CAT, constraints as CON, dlq as DLQ, gold as G, history as H, keys as KEYS, quality as Q
from ..operators import quarantine as QR, silver as S
from ..streaming import bronze_stream as STREAM, cdc_stream as CDC
from . import fixtures as FX
from . import replay as REPLAY
from . import run_log as LOG, runs as RUN
from ..sources import sinks, tables as T
from ..session import scratch_dir
from .fixtures import dirty_customers, table
from .medallion import CustomerFlow, layer_frames, layer_summary, run_medallion, run_summary

QUERIES: dict = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- scans / sinks
ORDERS_PROJECTION = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
LINEITEM_PROJECTION = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("scan_projected")
def scan_projected(spark, sf_dir):
    return T.scan_projected(spark, sf_dir, "orders", ORDERS_PROJECTION)


@query("scan_table")
def scan_table(spark, sf_dir):
    return T.scan_table(spark, sf_dir, "customer")


SCAN_QUERY = "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderpriority = '1-URGENT'"


@query("scan_query")
def scan_query(spark, sf_dir):
    return T.scan_query(spark, SCAN_QUERY, orders=table(spark, sf_dir, "orders"))


@query("scan_partitioned")
def scan_partitioned(spark, sf_dir):
    # ranges of the key with about as many rows each, their bounds pushed into the scans; sources.tables.read_jdbc_ranges reads a
    # database that way, tested against embedded Derby
    return T.scan_ranges(table(spark, sf_dir, "lineitem"), "l_orderkey", 8, LINEITEM_PROJECTION)


PARAM_QUERY = ("SELECT o_orderkey, o_totalprice FROM {orders} "
               "WHERE o_orderstatus = :status AND o_totalprice > :min_price")


@query("param_query")
def param_query(spark, sf_dir):
    return T.scan_query(spark, PARAM_QUERY, args={"status": "O", "min_price": 200000.0},
                        orders=table(spark, sf_dir, "orders"))


@query("sink_append_roundtrip")
def sink_append_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "sink_append") + "/customer"
    cust = table(spark, sf_dir, "customer")
    for batch in (C.BATCH_ID, C.NEXT_BATCH_ID):
        sinks.write_table(cust.withColumn("batch_id", F.lit(batch)), path, "append", partition_by="batch_id")
    return spark.read.parquet(path)


@query("sink_replace_roundtrip")
def sink_replace_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "sink_replace") + "/orders"
    orders = table(spark, sf_dir, "orders")
    sinks.write_table(orders.withColumn("o_orderpriority", F.concat(F.lit("old "), "o_orderpriority")), path, "replace",
                      partition_by="o_orderpriority")
    sinks.write_table(orders, path, "replace", partition_by="o_orderpriority")   # no old partition may survive
    return spark.read.parquet(path)


# ---------------------------------------------------------------- bronze
@query("bronze_lenient")
def bronze_lenient(spark, sf_dir):
    return B.stringify(table(spark, sf_dir, "customer"))


@query("bronze_audit_lenient")
def bronze_audit_lenient(spark, sf_dir):
    return B.audit_lenient(B.stringify(table(spark, sf_dir, "customer")), "customer", C.BATCH_ID, C.LOAD_TS,
                           key_cols=("c_custkey",))


@query("bronze_audit_snapshot")
def bronze_audit_snapshot(spark, sf_dir):
    return B.audit_snapshot(table(spark, sf_dir, "part"), "part", C.BATCH_ID, C.LOAD_TS)


@query("bronze_audit_sqlserver")
def bronze_audit_sqlserver(spark, sf_dir):
    return B.audit_sqlserver(table(spark, sf_dir, "orders"), "dbo", "orders", C.LOAD_TS)


@query("bronze_audit_extended")
def bronze_audit_extended(spark, sf_dir):
    once = B.audit_extended(B.stringify(table(spark, sf_dir, "supplier")), "dbo", "supplier", C.LOAD_TS, C.BATCH_ID)
    return B.audit_extended(once, "dbo", "supplier", C.LOAD_TS, C.BATCH_ID)   # idempotent


@query("record_hash_sha256")
def record_hash_sha256(spark, sf_dir):
    li = B.stringify(table(spark, sf_dir, "lineitem"))
    return li.select("l_orderkey", "l_linenumber", sha256_record_hash(li.columns).alias("record_hash"))


@query("record_hash_md5")
def record_hash_md5(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", md5_record_hash(p.columns).alias("record_hash"))


@query("surrogate_key")
def surrogate_key(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", uuid_from_md5("customer", C.BATCH_ID, F.col("c_custkey"), md5_record_hash(c.columns)).alias("surrogate_key"))


@query("bronze_typed_conform")
def bronze_typed_conform(spark, sf_dir):
    orders = B.stringify(table(spark, sf_dir, "orders"))
    sinks.write_batch(B.unreadable(orders, C.ORDERS_TYPED, C.BATCH_ID), scratch_dir(spark, "typed") + "/bronze/unreadable/orders",
                      "batch_id", C.BATCH_ID)
    return B.conform_typed(orders, C.ORDERS_TYPED)


TARGET_PATTERN = "bronze_{env}.{schema}_{table}_{date}"
LOAD_DAYS = ("2024-01-01", "2024-01-02")


@query("target_by_date")
def target_by_date(spark, sf_dir):
    # two days in two environments, the second day twice; read back: one environment, the second day
    lake, orders = scratch_dir(spark, "targets"), table(spark, sf_dir, "orders")
    for env in ("dev", "prod"):
        target = B.resolve_target(TARGET_PATTERN, "dbo", "orders", env)
        for day in (*LOAD_DAYS, LOAD_DAYS[1]):
            sinks.write_target(orders.filter(F.col("o_orderstatus") != "P") if env == "dev" else orders, lake, target, day)
    return sinks.read_target(spark, lake, target, since=LOAD_DAYS[1]).withColumn("layer", F.lit(target.layer))


COLUMN_OVERRIDES = {"o_totalprice": "CAST(o_totalprice AS DECIMAL(12,2))",
                    "o_orderdate": "CAST(o_orderdate AS DATE)"}


@query("column_overrides")
def column_overrides(spark, sf_dir):
    return B.apply_overrides(table(spark, sf_dir, "orders"), COLUMN_OVERRIDES, exclude=("o_orderpriority",))


# ---------------------------------------------------------------- bronze DLQ
def _dlq_checked(spark, sf_dir):
    return DLQ.checked(dirty_customers(spark, sf_dir))


@query("dlq_good")
def dlq_good(spark, sf_dir):
    return DLQ.good_rows(_dlq_checked(spark, sf_dir), "customer", C.BATCH_ID, C.LOAD_TS)


@query("dlq_bad")
def dlq_bad(spark, sf_dir):
    return DLQ.dlq_rows(_dlq_checked(spark, sf_dir), "customer", C.BATCH_ID)


@query("dlq_record")
def dlq_record(spark, sf_dir):
    return DLQ.dlq_model_rows(dlq_bad(spark, sf_dir), C.LOAD_TS)


def _constrained(spark, sf_dir):
    """A landed customer batch, checked by the row contract and by rules over the whole batch, stored bronze and the parent table."""
    landed = CON.land(FX.customer_batch(spark, sf_dir), scratch_dir(spark, "landed") + "/customer", C.BATCH_ID)
    rules = [CON.MaxLength("first_name", C.NAME_CHARS), CON.Between("store_id", 1, 2),
             CON.Unique(["customer_id"], FX.stored_customers(spark, sf_dir)),
             CON.Parent("address_id", FX.address_parents(spark, sf_dir), "address_id")]
    checked = CON.apply(DLQ.checked(landed), rules)
    return checked.drop(CON.ROW_ID)


@query("dlq_classify")
def dlq_classify(spark, sf_dir):
    bad = DLQ.dlq_rows(_constrained(spark, sf_dir), "customer", C.BATCH_ID)
    return bad.groupBy("error_type", "failed_field", "error_message").agg(F.count(F.lit(1)).alias("failures"))


@query("dlq_extract")
def dlq_extract(spark, sf_dir):
    return dlq_bad(spark, sf_dir).select("error_message", "failed_field", "expected_type", "actual_value")


@query("dlq_summary")
def dlq_summary(spark, sf_dir):
    return DLQ.summary(_dlq_checked(spark, sf_dir))


# ---------------------------------------------------------------- silver
def _flow(spark, sf_dir) -> CustomerFlow:
    return CustomerFlow(spark, sf_dir)


@query("silver_current")
def silver_current(spark, sf_dir):
    return S.current_rows(_flow(spark, sf_dir).bronze())


def _rule_report(spark, sf_dir, rules):
    cur = S.current_rows(_flow(spark, sf_dir).bronze())
    cols = [F.col("br_customer_key")]
    for r in rules:
        e = r.error
        cols += [F.col(r.field).alias(f"{r.field}_raw"),
                 r.value.alias(f"{r.field}_value"),
                 e["category"].alias(f"{r.field}_category"),
                 e["message"].alias(f"{r.field}_message"),
                 e["actual_value"].alias(f"{r.field}_actual")]
    return cur.select(*cols)


@query("v_required_int")
def v_required_int(spark, sf_dir):
    return _rule_report(spark, sf_dir, [R.required_int("customer_id"), R.required_int("store_id")])


@query("v_required_string")
def v_required_string(spark, sf_dir):
    return _rule_report(spark, sf_dir, [R.required_string("first_name"), R.required_string("last_name")])


@query("v_email")
def v_email(spark, sf_dir):
    return _rule_report(spark, sf_dir, [R.email("email")])


@query("v_optional_int")
def v_optional_int(spark, sf_dir):
    return _rule_report(spark, sf_dir, [R.optional_int("address_id")])


@query("v_boolean_like")
def v_boolean_like(spark, sf_dir):
    return _rule_report(spark, sf_dir, [R.bool_like("activebool")])


@query("v_iso_datetime")
def v_iso_datetime(spark, sf_dir):
    return _rule_report(spark, sf_dir, [R.iso_datetime("create_date"), R.iso_datetime("last_update")])


@query("v_flag01")
def v_flag01(spark, sf_dir):
    return _rule_report(spark, sf_dir, [R.flag01("active")])


@query("silver_first_failure")
def silver_first_failure(spark, sf_dir):
    return S.first_failure_view(_flow(spark, sf_dir).validated(), "br_customer_key")


@query("silver_clean")
def silver_clean(spark, sf_dir):
    return _flow(spark, sf_dir).silver()


@query("silver_quarantine")
def silver_quarantine(spark, sf_dir):
    return _flow(spark, sf_dir).quarantine()


@query("silver_stats")
def silver_stats(spark, sf_dir):
    return S.promotion_stats(_flow(spark, sf_dir).validated(), "sl_customer")


ORDERS_PASSTHROUGH = ("o_orderkey", "o_custkey", "o_orderpriority")


@query("silver_promote_generic")
def silver_promote_generic(spark, sf_dir):
    clean, _, _ = S.promote(table(spark, sf_dir, "orders"), R.orders_rules(), "o_orderkey", C.BATCH_ID, C.LOAD_TS,
                            source_table="br_orders", target_table="sl_orders", passthrough=ORDERS_PASSTHROUGH)
    return clean


@query("silver_derive")
def silver_derive(spark, sf_dir):
    return S.derive(_flow(spark, sf_dir).silver(), C.AS_OF_DATE)


# ---------------------------------------------------------------- gold
@query("dim_customer")
def dim_customer(spark, sf_dir):
    return _flow(spark, sf_dir).dim_customer()


@query("customer_segment")
def customer_segment(spark, sf_dir):
    s = _flow(spark, sf_dir).silver()
    return s.select("customer_id", "email", "first_name", "last_name", G.customer_segment().alias("customer_segment"))


@query("email_domain")
def email_domain(spark, sf_dir):
    s = _flow(spark, sf_dir).silver()
    return s.select("customer_id", "email", G.email_domain().alias("email_domain"))


@query("name_length_bucket")
def name_length_bucket(spark, sf_dir):
    s = _flow(spark, sf_dir).silver()
    return s.select("customer_id", "first_name", "last_name", G.name_length_bucket().alias("name_length_category"))


@query("dim_date")
def dim_date(spark, sf_dir):
    return _flow(spark, sf_dir).dim_date()


@query("dim_date_flags")
def dim_date_flags(spark, sf_dir):
    legacy = G.legacy_month_end(F.col("full_date"))
    return _flow(spark, sf_dir).dim_date().select(
        "date_key", "is_weekend", "is_month_end", "is_quarter_end", "is_year_end",
        legacy.alias("compat_is_month_end"),
        (F.col("month").isin(3, 6, 9, 12) & legacy).alias("compat_is_quarter_end"))


@query("kpi_customer_summary")
def kpi_customer_summary(spark, sf_dir):
    return _flow(spark, sf_dir).kpi()


@query("customer_summary_view")
def customer_summary_view(spark, sf_dir):
    return G.orders_summary_view(table(spark, sf_dir, "orders"))


# ---------------------------------------------------------------- gold statistics / layers
def _stored_layers(spark, sf_dir) -> dict:
    run = run_medallion(spark, sf_dir, scratch_dir(spark, "lake"))
    return layer_frames(spark, run["paths"], run["batch_id"])


@query("layer_listing")
def layer_listing(spark, sf_dir):
    run = run_medallion(spark, sf_dir, scratch_dir(spark, "lake"))
    return layer_summary(spark, run["paths"], run["batch_id"]).withColumnRenamed("row_count", "record_count")


@query("gold_stats")
def gold_stats(spark, sf_dir):
    frames = _stored_layers(spark, sf_dir)
    gold = {name: df for (layer, name), df in frames.items() if layer == "gold"}
    c = Q.counts(gold)
    per_object = c.select(F.col("name").alias("object_name"), F.col("n").alias("records"),
                          (F.col("n") > 0).alias("success"))
    return G.gold_stats(per_object, C.BATCH_ID)


# ---------------------------------------------------------------- catalog
RELATIONAL = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@query("layer_row_counts")
def layer_row_counts(spark, sf_dir):
    return CAT.row_counts(spark, sf_dir, C.DRIVER_TABLES)


@query("table_metadata")
def table_metadata(spark, sf_dir):
    return CAT.table_metadata(spark, sf_dir, C.DRIVER_TABLES)


@query("catalog_columns")
def catalog_columns(spark, sf_dir):
    return CAT.column_catalog(spark, sf_dir, C.DRIVER_TABLES).drop("is_primary_key", "references_column")


DISCOVER_PATTERN = "e"


@query("discover_tables")
def discover_tables(spark, sf_dir):
    return CAT.discover(spark, sf_dir, DISCOVER_PATTERN)


SELECT_INCLUDE = "^(customer|orders|lineitem|part|supplier|nation|region)$"
SELECT_EXCLUDE = "^(region|nation)$"


@query("select_tables")
def select_tables(spark, sf_dir):
    names = CAT.filter_names(CAT.list_tables(spark, sf_dir))
    return CAT.include_exclude(names, SELECT_INCLUDE, SELECT_EXCLUDE).select("table_name")


def _frames(spark, sf_dir):
    return {t: table(spark, sf_dir, t) for t in C.DRIVER_TABLES}


@query("fk_candidates")
def fk_candidates(spark, sf_dir):
    return CAT.fk_candidates(spark, sf_dir, C.DRIVER_TABLES)


@query("inclusion_dependencies")
def inclusion_dependencies(spark, sf_dir):
    return KEYS.inclusions(_frames(spark, sf_dir), scratch_dir(spark, "profile"))


@query("key_candidates")
def key_candidates(spark, sf_dir):
    return KEYS.keys(_frames(spark, sf_dir), scratch_dir(spark, "profile"))


@query("table_storage")
def table_storage(spark, sf_dir):
    return CAT.storage(spark, sf_dir, C.DRIVER_TABLES)


@query("table_registry_storage")
def table_registry_storage(spark, sf_dir):
    rows = CAT.registry_rows(spark, {t: table(spark, sf_dir, t) for t in C.DRIVER_TABLES}, C.LOAD_TS)
    return CAT.with_storage(rows, CAT.storage(spark, sf_dir, C.DRIVER_TABLES), CAT.masked(C.CONNECTION_TEXT))


@query("table_registry_upsert")
def table_registry_upsert(spark, sf_dir):
    old = CAT.registry_rows(spark, {
        "customer": FX.customer_snapshot_1(spark, sf_dir), "part": table(spark, sf_dir, "part"),
        "orders": table(spark, sf_dir, "orders"), "nation": table(spark, sf_dir, "nation")}, C.LOAD_TS)
    old = old.withColumns({"created_at": F.lit(C.LOAD_TS).cast("timestamp_ntz"),
                           "updated_at": F.lit(C.LOAD_TS).cast("timestamp_ntz")})
    new = CAT.registry_rows(spark, {
        "customer": table(spark, sf_dir, "customer"), "part": FX.part_snapshot_2(spark, sf_dir),
        "orders": table(spark, sf_dir, "orders"), "supplier": table(spark, sf_dir, "supplier")}, C.NEXT_LOAD_TS)
    return CAT.upsert_registry(old, new, C.NEXT_LOAD_TS)


# ---------------------------------------------------------------- quality
def _tables(spark, sf_dir, names):
    return {t: table(spark, sf_dir, t) for t in names}


@query("dq_reconcile")
def dq_reconcile(spark, sf_dir):
    return run_medallion(spark, sf_dir, scratch_dir(spark, "lake"))["checks"]


@query("dq_duplicates")
def dq_duplicates(spark, sf_dir):
    return Q.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_sum_match")
def dq_sum_match(spark, sf_dir):
    return Q.sum_match(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


@query("dq_foreign_keys")
def dq_foreign_keys(spark, sf_dir):
    return Q.foreign_keys(_tables(spark, sf_dir, RELATIONAL), C.FOREIGN_KEYS)


AUDIT_COLUMNS = ("br_customer_key", "br_load_time", "br_source_file", "br_record_hash", "br_is_current", "br_batch_id")


@query("dq_audit_populated")
def dq_audit_populated(spark, sf_dir):
    return Q.nulls_in(_flow(spark, sf_dir).bronze(), "br_customer", AUDIT_COLUMNS, "audit_populated")


REQUIRED_COLUMNS = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_phone"),
    "orders": ("o_orderkey", "o_custkey", "o_orderdate"),
    "events": ("event_id", "ts", "user_id", "event_type"),
}


@query("dq_completeness")
def dq_completeness(spark, sf_dir):
    return Q.union_all([Q.completeness(table(spark, sf_dir, t), t, cols) for t, cols in REQUIRED_COLUMNS.items()])


@query("dq_uniqueness")
def dq_uniqueness(spark, sf_dir):
    return Q.union_all([Q.uniqueness(table(spark, sf_dir, t), t, keys) for t, keys in C.PRIMARY_KEYS.items()])


FRESHNESS = (("events", "ts", "2024-02-01 00:00:00", 86400),
             ("lineitem", "l_shipdate", "2002-01-01 00:00:00", 30 * 86400))


@query("dq_freshness")
def dq_freshness(spark, sf_dir):
    return Q.union_all([Q.freshness(table(spark, sf_dir, t), t, c, as_of, lag) for t, c, as_of, lag in FRESHNESS])


# ---------------------------------------------------------------- history
FIRST_LOAD_END = "2024-01-16 00:00:00"
SECOND_LOAD_START = "2024-01-10 00:00:00"


@query("incremental_watermark")
def incremental_watermark(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    loaded = ev.filter(F.col("ts") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz"))
    return H.watermark_increment(loaded, ev, "ts")


def _scd2(spark, sf_dir):
    keys = ["c_custkey"]
    hist = H.scd2_initial(FX.customer_snapshot_1(spark, sf_dir), keys, C.LOAD_TS, C.BATCH_ID)
    incoming = FX.customer_snapshot_2(spark, sf_dir)
    _, faulty = RUN.set_aside(incoming, keys, "customer", scratch_dir(spark, "scd2"), C.NEXT_BATCH_ID)
    return H.scd2_apply(hist, incoming, keys, C.NEXT_LOAD_TS, C.NEXT_BATCH_ID, faulty)


@query("scd2_apply")
def scd2_apply(spark, sf_dir):
    return _scd2(spark, sf_dir)


@query("scd2_late_load")
def scd2_late_load(spark, sf_dir):
    # four loads; the second and the first by time arrive last
    keys, lake = ["c_custkey"], scratch_dir(spark, "scd2_late")
    loads, runs = [], None
    for k, (t, batch, snapshot) in enumerate(FX.customer_loads(spark, sf_dir)):
        _, faulty = RUN.set_aside(snapshot, keys, "customer", lake, batch)
        runs = (H.runs_initial(snapshot, keys, t, batch, faulty) if runs is None
                else H.runs_insert(runs, snapshot, keys, t, batch, loads, faulty))
        sinks.write_table(runs, f"{lake}/history/{k}", "replace")   # every load leaves a stored version
        runs = spark.read.schema(runs.schema).parquet(f"{lake}/history/{k}")
        loads.append((t, batch))
    return H.runs_versions(runs, keys)


def _event_loads(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    first = ev.filter(F.col("ts") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz"))
    second = ev.filter(F.col("ts") >= F.lit(SECOND_LOAD_START).cast("timestamp_ntz"))
    loads = []
    for df, batch, ts in ((first, C.BATCH_ID, C.LOAD_TS), (second, C.NEXT_BATCH_ID, C.NEXT_LOAD_TS)):
        h = df.withColumn("br_record_hash", md5_record_hash(ev.columns))
        loads.append(h.select("*", uuid_from_md5("events", batch, F.col("event_id")).alias("br_events_key"),
                              F.lit(ts).cast("timestamp_ntz").alias("br_load_time"),
                              F.lit(batch).alias("br_batch_id")))
    return loads[0].unionByName(loads[1])


@query("dedup_row_hash")
def dedup_row_hash(spark, sf_dir):
    return H.dedup_earliest(_event_loads(spark, sf_dir), ["event_id", "br_record_hash"],
                            ["br_load_time", "br_events_key"])


@query("soft_delete_mark")
def soft_delete_mark(spark, sf_dir):
    bronze = table(spark, sf_dir, "customer").withColumn("_bronze_batch_id", F.lit(C.BATCH_ID))
    return H.soft_delete(bronze, FX.customer_snapshot_2(spark, sf_dir), ["c_custkey"], C.NEXT_LOAD_TS)


@query("reference_inactivate")
def reference_inactivate(spark, sf_dir):
    return H.inactivate(table(spark, sf_dir, "part"), FX.part_snapshot_2(spark, sf_dir), ["p_partkey"],
                        C.AS_OF_DATE, "reference_sync")


@query("cdc_events")
def cdc_events(spark, sf_dir):
    lake, keys = scratch_dir(spark, "cdc_events"), ["c_custkey"]
    s1, s2 = FX.customer_snapshot_1(spark, sf_dir), FX.customer_snapshot_2(spark, sf_dir)
    _, f1 = RUN.set_aside(s1, keys, "customer", lake, C.BATCH_ID)
    _, f2 = RUN.set_aside(s2, keys, "customer", lake, C.NEXT_BATCH_ID)
    return H.change_events(s1, s2, keys, "customer", C.NEXT_LOAD_TS, f1, f2)


# ---------------------------------------------------------------- quarantine replay / report
@query("quarantine_replay")
def quarantine_replay(spark, sf_dir):
    updated, _ = QR.replay(_flow(spark, sf_dir).quarantine(), list(C.CUSTOMER_FIELDS), QR.default_fixes(),
                           R.customer_rules(), C.NEXT_LOAD_TS)
    return updated


REPLAY_ID = "replay_1"


def _replayed(spark, sf_dir):
    """A stored medallion whose quarantine batch was replayed, and replayed again under the same id."""
    lake = run_medallion(spark, sf_dir, scratch_dir(spark, "lake"))["paths"]["sl_customer"].rsplit("/silver/", 1)[0]
    for _ in range(2):
        REPLAY.replay_batch(spark, lake, C.BATCH_ID, REPLAY_ID, list(C.CUSTOMER_FIELDS), QR.default_fixes(), R.customer_rules(), C.NEXT_LOAD_TS)
    return lake


@query("replay_promoted")
def replay_promoted(spark, sf_dir):
    path = _replayed(spark, sf_dir) + "/silver/sl_customer"
    return spark.read.option("basePath", path).parquet(sinks.batch_path(path, "sl_batch_id", REPLAY.silver_batch(C.BATCH_ID, REPLAY_ID)))


@query("replay_quarantine")
def replay_quarantine(spark, sf_dir):
    path = f"{_replayed(spark, sf_dir)}/{REPLAY.ERRORS}"
    return spark.read.option("basePath", path).parquet(sinks.batch_path(path, "batch_id", C.BATCH_ID)).select(
        "error_id", "br_source_key", "batch_id", "error_category", "failed_field", "remediation_status", "retry_count", "last_retry_at", "remediation_notes",
        "resolved_at", "resolution_method")


@query("quarantine_report")
def quarantine_report(spark, sf_dir):
    return QR.report(_flow(spark, sf_dir).quarantine())


# ---------------------------------------------------------------- runs (H), sinks (A8/A9)
INGEST_SPECS = ("dbo.customer", "dbo.orders", "dbo.part")


def _ingest(spark, sf_dir, names=INGEST_SPECS, max_workers=1):
    lake = scratch_dir(spark, "ingest")
    audit = RUN.RunAudit("parquet", C.BATCH_ID)
    RUN.ingest_many(spark, RUN.parquet_reader(spark, sf_dir), [RUN.TableSpec.parse(n) for n in names],
                    lake, C.LOAD_TS, audit, max_workers=max_workers)
    return lake, audit


@query("ingest_single")
def ingest_single(spark, sf_dir):
    lake, audit = _ingest(spark, sf_dir, ("dbo.orders",))
    return spark.read.parquet(f"{lake}/bronze/dbo_orders")


# audit columns that do not depend on wall-clock time
AUDIT_OUTCOME = ("audit_id", "source_system", "source_schema", "source_table", "target_table", "rows_processed",
                 "status", "error_message", "batch_id")


@query("ingest_multi")
def ingest_multi(spark, sf_dir):
    _, audit = _ingest(spark, sf_dir, max_workers=3)
    return audit.frame(spark).select(*AUDIT_OUTCOME)


@query("run_audit")
def run_audit(spark, sf_dir):
    _, audit = _ingest(spark, sf_dir)
    return audit.frame(spark).select(*AUDIT_OUTCOME, F.lit(audit.total_rows()).cast("bigint").alias("run_total_rows"),
                                     F.lit(audit.success()).alias("run_success"))


class _Killed(BaseException):
    """A run that ends without a word, as when its process is killed."""


@query("run_log")
def run_log(spark, sf_dir):
    # two runs of one batch: the first dies while it reads orders and never comes to part, the second finds no table of that name either
    lake, read = scratch_dir(spark, "run_log"), RUN.parquet_reader(spark, sf_dir)
    begin = dt.datetime.fromisoformat(C.LOAD_TS)
    for n, names in enumerate((INGEST_SPECS, (*INGEST_SPECS, "dbo.nowhere"))):
        minutes = itertools.count()
        audit = RUN.RunAudit("parquet", C.BATCH_ID, log=LOG.RunLog(spark, f"{lake}/log", f"run_{n + 1}"),
                             clock=lambda n=n, minutes=minutes: begin + dt.timedelta(days=n, minutes=next(minutes)))

        def reader(spec, n=n):
            if n == 0 and spec.source_table == "orders":
                raise _Killed
            return read(spec)
        try:
            RUN.ingest_many(spark, reader, [RUN.TableSpec.parse(x) for x in names], lake, C.LOAD_TS, audit)
        except _Killed:
            pass
    states = LOG.states(LOG.events(spark, f"{lake}/log"), begin + dt.timedelta(days=1, hours=1))
    return states.select("run_id", *AUDIT_OUTCOME, "run_date", "ingestion_started_at").withColumn("error_message", F.col("error_message").isNotNull())


@query("run_audit_json")
def run_audit_json(spark, sf_dir):
    lake, audit = _ingest(spark, sf_dir)
    sinks.write_json(audit.frame(spark), f"{lake}/metadata/run_audit")
    return spark.read.schema(LOG.AUDIT_SCHEMA).json(f"{lake}/metadata/run_audit").select(*AUDIT_OUTCOME)


@query("ingest_all")
def ingest_all(spark, sf_dir):
    lake = scratch_dir(spark, "ingest_all")
    audit = RUN.RunAudit("parquet", C.BATCH_ID)
    RUN.ingest_all(spark, sf_dir, RUN.parquet_reader(spark, sf_dir), lake, C.LOAD_TS, audit,
                   include=SELECT_INCLUDE, exclude=SELECT_EXCLUDE)
    return audit.frame(spark).select(*AUDIT_OUTCOME)


@query("bronze_run")
def bronze_run(spark, sf_dir):
    return RUN.bronze_run(spark, sf_dir, scratch_dir(spark, "bronze_run")).drop("seconds")


@query("sink_modes")
def sink_modes(spark, sf_dir):
    base = scratch_dir(spark, "sink_modes")
    nation = table(spark, sf_dir, "nation")
    target = f"{base}/bronze/" + B.target_name("{schema}_{table}", schema="dbo", table="nation")
    rows = []
    for mode in ("append", "append", "replace", "fail"):
        try:
            n = sinks.write_table(nation, target, mode)
            outcome = "written"
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            n, outcome = 0, "rejected"   # what 'fail' does on an existing table
        rows.append((mode, target.rsplit("/", 1)[1], n, outcome))
    res = T.local_frame(spark, rows, "if_exists string, target_table string, rows_written bigint, outcome string")
    # the target's final row count is one scalar: attached as a literal, not through a join
    final = spark.read.parquet(target).agg(F.count(F.lit(1))).first()[0]
    return res.withColumn("rows_in_target", F.lit(int(final)).cast("bigint"))


@query("medallion_end_to_end")
def medallion_end_to_end(spark, sf_dir):
    run = run_medallion(spark, sf_dir, scratch_dir(spark, "lake"))
    return run_summary(spark, run)


# ---------------------------------------------------------------- streaming
def _streamed(spark, sf_dir) -> str:
    """Customers as landed files, streamed in; then every file is delivered again under another name, and the stream goes on."""
    base = scratch_dir(spark, "stream_quarantine")
    table(spark, sf_dir, "customer").write.parquet(f"{base}/landing")
    for _ in range(2):
        stream = STREAM.customer_bronze_stream(spark, sf_dir, lambda raw: FX.dirty_rows(raw, STREAM.PLACE), source_dir=f"{base}/landing", glob="*.parquet")
        STREAM.start_quarantine_stream(stream, f"{base}/lake", f"{base}/_checkpoint", C.BATCH_ID, C.LOAD_TS).awaitTermination()
        sinks.copy_files(spark, f"{base}/landing", "again-")
    return f"{base}/lake"


@query("stream_quarantine")
def stream_quarantine(spark, sf_dir):
    return spark.read.parquet(f"{_streamed(spark, sf_dir)}/silver/sl_transformation_errors").drop("stream_epoch")


@query("stream_bronze")
def stream_bronze(spark, sf_dir):
    return spark.read.parquet(f"{_streamed(spark, sf_dir)}/bronze/br_customer").drop("stream_epoch")


CUSTOMER_ROW = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _customer_row():
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(CUSTOMER_ROW)


def _customer_event_state(spark, sf_dir, streams) -> str:
    """A state over the first snapshot and two rounds of published events, each round applied by a stream of its own (the second restarts the first):
    the changes twice, rivals of the deletes at their very time, late events that say again how every row of the first load was, and events
    that cannot be read, with the latest time of all."""
    base, keys, row = scratch_dir(spark, "stream_cdc"), ["c_custkey"], _customer_row()
    s1, s2 = FX.customer_snapshot_1(spark, sf_dir), FX.customer_snapshot_2(spark, sf_dir)
    _, f1 = RUN.set_aside(s1, keys, "customer", base, C.BATCH_ID)
    _, f2 = RUN.set_aside(s2, keys, "customer", base, C.NEXT_BATCH_ID)
    CDC.init_state(s1, f"{base}/state")
    changes = H.change_events(s1, s2, keys, "customer", C.NEXT_LOAD_TS, f1, f2)
    rounds = [[changes, FX.unreadable_events(spark, sf_dir, C.LAST_LOAD_TS)],
              [changes, changes.filter("operation = 'D'").withColumn("operation", F.lit("U")),
               H.change_events(s1.limit(0), s1, keys, "customer", C.LOAD_TS)]]
    for some in rounds:
        for events in some:
            CDC.publish(events, f"{base}/events")
        for start in streams:
            start(spark, f"{base}/events", f"{base}/state", keys, row, max_files=8).awaitTermination()
    return f"{base}/state"


@query("stream_cdc_apply")
def stream_cdc_apply(spark, sf_dir):
    path = _customer_event_state(spark, sf_dir, [CDC.start_apply_stream])
    return CDC.current(spark, path, ["c_custkey"], _customer_row())


@query("stream_cdc_faults")
def stream_cdc_faults(spark, sf_dir):
    path = _customer_event_state(spark, sf_dir, [CDC.start_fault_stream])
    return CDC.stored_faults(spark, path).drop(CDC.LINE)

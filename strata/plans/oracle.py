"""DuckDB twins of the registered queries (the correctness oracle).

Written independently in plain SQL over the driver tables (views named
after the tables). The SQL is assembled from small helpers so that long
CTE chains (bronze -> silver -> gold) are spelled once.
"""

from __future__ import annotations

from itertools import combinations

from .. import contracts as C
from . import fixtures as FX
from .fixtures import DIRTY_CUSTOMER_SQL

ORACLE: dict = {}

# spelled here on their own, not shared with the code they check
INT_PATTERN = "^[+-]?[0-9]+$"
ISO_DATETIME_PATTERN = ("^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?"
                        "(Z|[+-][0-9]{2}:[0-9]{2})?)?$")
PY_WHITESPACE = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                  0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

TS = f"TIMESTAMP '{C.LOAD_TS}'"
TS2 = f"TIMESTAMP '{C.NEXT_LOAD_TS}'"
BATCH = f"'{C.BATCH_ID}'"
BATCH2 = f"'{C.NEXT_BATCH_ID}'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def uuid_sql(*parts: str) -> str:
    # each part behind its length, NULL as a mark of its own
    inner = "concat_ws('|', " + ", ".join(f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), '-')" for p in parts) + ")"
    h = f"md5({inner})"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12))")


def json_obj(cols, exprs=None) -> str:
    exprs = exprs or {}
    return "{" + ", ".join(f"'{c}': {exprs.get(c, c)}" for c in cols) + "}"


def sha_sorted(cols, exprs=None) -> str:
    return f"sha256(to_json({json_obj(sorted(cols), exprs)}))"


def md5_join(cols) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in cols) + "))"


def strip(x): return f"trim({x}, {q(PY_WHITESPACE)})"
def falsy(x): return f"({x} IS NULL OR {x} = '')"
def pint(x): return f"(CASE WHEN regexp_matches({strip(x)}, '{INT_PATTERN}') THEN TRY_CAST({strip(x)} AS BIGINT) END)"


def pts(x):
    return (f"(CASE WHEN regexp_matches({x}, '{ISO_DATETIME_PATTERN}') AND NOT starts_with({x}, '0000') "
            f"THEN TRY_CAST({x} AS TIMESTAMP) END)")


def pbool(x):
    return (f"(CASE WHEN lower({x}) IN ('true', '1', 'yes', 't') THEN TRUE "
            f"WHEN lower({x}) IN ('false', '0', 'no', 'f') THEN FALSE END)")


def err(cat, msg, field, actual="NULL", expected="NULL"):
    return ("{'category': " + q(cat) + ", 'message': " + msg + ", 'failed_field': " + q(field)
            + ", 'expected_value': CAST(" + expected + " AS VARCHAR), 'actual_value': CAST(" + actual + " AS VARCHAR)}")


# Each rule: (field, [(condition, error_struct)], value_expr)
def r_required_int(f):
    return (f, [(falsy(f), err("MISSING_FIELD", q(f"{f} is required but missing"), f)),
                (f"{pint(f)} IS NULL", err("DATA_TYPE", f"{q(f + ' must be integer, got: ')} || {f}", f, f))],
            pint(f))


def r_required_string(f):
    s = strip(f)
    shown = f"CASE WHEN length({s}) > 50 THEN substr({s}, 1, 50) || '...' ELSE {s} END"
    return (f, [(falsy(f), err("MISSING_FIELD", q(f"{f} is required but missing"), f)),
                (f"length({s}) > 100", err("BUSINESS_RULE", q(f"{f} exceeds 100 character limit"), f, shown))],
            s)


def r_email(f):
    e = f"lower({strip(f)})"
    ok = f"(contains({e}, '@') AND contains(split_part({e}, '@', 2), '.'))"   # stated independently of the regex
    return (f, [(falsy(f), err("MISSING_FIELD", q(f"{f} is required but missing"), f)),
                (f"NOT {ok}", err("BUSINESS_RULE", q(f"{f} format is invalid"), f, e))],
            e)


def r_optional_int(f):
    return (f, [(f"NOT {falsy(f)} AND {pint(f)} IS NULL",
                 err("DATA_TYPE", f"{q(f + ' must be integer, got: ')} || {f}", f, f))],
            f"CASE WHEN NOT {falsy(f)} THEN {pint(f)} END")


def r_bool_like(f):
    return (f, [(f"{f} IS NOT NULL AND {pbool(f)} IS NULL",
                 err("DATA_TYPE", f"{q(f + ' must be boolean-like, got: ')} || {f}", f, f))],
            f"coalesce({pbool(f)}, TRUE)")


def r_iso_datetime(f):
    return (f, [(f"NOT {falsy(f)} AND {pts(f)} IS NULL", err("DATA_TYPE", q(f"{f} is not a valid datetime"), f, f))],
            f"CASE WHEN NOT {falsy(f)} THEN {pts(f)} END")


def r_flag01(f):
    return (f, [(f"{f} IS NOT NULL AND {pint(f)} IS NULL",
                 err("DATA_TYPE", f"{q(f + ' must be integer, got: ')} || {f}", f, f)),
                (f"{f} IS NOT NULL AND {pint(f)} NOT IN (0, 1)", err("BUSINESS_RULE", q(f"{f} must be 0 or 1"), f, f))],
            f"coalesce({pint(f)}, 1)")


CUSTOMER_RULES = [r_required_int("customer_id"), r_required_int("store_id"), r_required_string("first_name"),
                  r_required_string("last_name"), r_email("email"), r_optional_int("address_id"),
                  r_bool_like("activebool"), r_iso_datetime("create_date"), r_iso_datetime("last_update"),
                  r_flag01("active")]


def case_of(rules) -> str:
    arms = [f"WHEN {cond} THEN {e}" for _, rule_arms, _ in rules for cond, e in rule_arms]
    return "CASE " + " ".join(arms) + " END"


FIELDS = list(C.CUSTOMER_FIELDS)
SILVER_SRC = ["br_customer_key", *FIELDS, "br_load_time", "br_batch_id", "br_record_hash"]
DIRTY = DIRTY_CUSTOMER_SQL.replace("{customer}", "customer")


def segment_sql(email="email", first="first_name", last="last_name"):
    e = f"lower(coalesce({email}, ''))"
    n = f"(length(coalesce({first}, '')) + length(coalesce({last}, '')))"
    return (f"CASE WHEN contains({e}, 'gmail.com') OR contains({e}, 'yahoo.com') OR contains({e}, 'hotmail.com') "
            f"THEN 'Standard' WHEN contains({e}, '.edu') OR contains({e}, '.gov') OR contains({e}, '.org') "
            f"THEN 'Premium' WHEN {n} > 20 THEN 'Premium' ELSE 'Basic' END")


def domain_sql(email="email"):
    return f"CASE WHEN contains({email}, '@') THEN split_part({email}, '@', 2) ELSE 'unknown' END"


def bucket_sql(first="first_name", last="last_name"):
    n = f"(length(coalesce({first}, '')) + length(coalesce({last}, '')))"
    return f"CASE WHEN {n} <= 10 THEN 'Short' WHEN {n} <= 20 THEN 'Medium' ELSE 'Long' END"


CUSTOMER_CTES = f"""
dirty AS ({DIRTY}),
bronze0 AS (SELECT *, {sha_sorted(FIELDS)} AS br_record_hash FROM dirty),
bronze AS (
  SELECT {', '.join(FIELDS)},
         {uuid_sql("'customer'", BATCH, 'customer_id', 'br_record_hash')} AS br_customer_key,
         {TS} AS br_load_time, 'customer_{C.BATCH_ID}' AS br_source_file, br_record_hash,
         TRUE AS br_is_current, {BATCH} AS br_batch_id
  FROM bronze0),
cur AS (SELECT {', '.join(SILVER_SRC)} FROM bronze WHERE br_is_current),
validated AS (
  SELECT *, {case_of(CUSTOMER_RULES)} AS err,
         {', '.join(f'{v} AS v_{f}' for f, _, v in CUSTOMER_RULES)}
  FROM cur),
silver AS (
  SELECT {', '.join(f'v_{f} AS {f}' for f in FIELDS)},
         {uuid_sql("'sl_customer'", BATCH, 'br_customer_key')} AS sl_customer_key,
         br_customer_key AS br_source_key, {TS} AS sl_load_time, {BATCH} AS sl_batch_id
  FROM validated WHERE err IS NULL),
quarantine AS (
  SELECT {uuid_sql("'error'", "'br_customer'", BATCH, 'br_customer_key')} AS error_id,
         br_customer_key AS br_source_key, 'br_customer' AS source_table, 'sl_customer' AS target_table,
         {BATCH} AS batch_id, to_json({json_obj(SILVER_SRC)}) AS bronze_record_json,
         err.category AS error_category, err.message AS error_message, err.failed_field AS failed_field,
         err.expected_value AS expected_value, err.actual_value AS actual_value,
         'br_customer_to_sl_customer_validation' AS transformation_rule, 'MEDIUM' AS severity,
         'PENDING' AS remediation_status, {TS} AS created_at, 0 AS retry_count, FALSE AS alert_sent
  FROM validated WHERE err IS NOT NULL),
dim AS (
  SELECT sl_customer_key AS dim_customer_key, customer_id, first_name, last_name,
         coalesce(first_name, 'None') || ' ' || coalesce(last_name, 'None') AS full_name, email,
         (coalesce(activebool, FALSE) AND coalesce(active = 1, FALSE)) AS is_active,
         {segment_sql()} AS customer_segment, {domain_sql()} AS email_domain,
         {bucket_sql()} AS name_length_category, sl_load_time AS effective_date, TRUE AS is_current,
         {BATCH} AS batch_id, {TS} AS created_at
  FROM silver),
kpi AS (
  SELECT *,
         CASE WHEN total_customers > 0 THEN active_customers / total_customers * 100 ELSE 0.0 END
           AS active_customer_rate,
         CASE WHEN total_customers > 0 THEN premium_customers / total_customers * 100 ELSE 0.0 END
           AS premium_customer_rate,
         DATE '{C.AS_OF_DATE}' AS measurement_date, {BATCH} AS batch_id, {TS} AS created_at
  FROM (SELECT count(*) AS total_customers, count_if(is_active) AS active_customers,
               count_if(NOT is_active) AS inactive_customers, count(DISTINCT email_domain) AS unique_email_domains,
               count_if(customer_segment = 'Premium') AS premium_customers,
               count_if(customer_segment = 'Standard') AS standard_customers,
               count_if(customer_segment = 'Basic') AS basic_customers
        FROM dim WHERE is_current))
"""


def with_customer(select: str) -> str:
    return f"WITH {CUSTOMER_CTES} {select}"


DATE_DAYS = """
span AS (SELECT make_date(year(min(o_orderdate)), 1, 1) AS s, make_date(year(max(o_orderdate)), 12, 31) AS e
         FROM orders),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
"""
LEGACY_MONTH_END = "(day(make_date(year(d), month(d), 28) + INTERVAL 4 DAY) <= 4)"


def dim_date_sql() -> str:
    return f"""WITH {DATE_DAYS}
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_abbr, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_abbr,
       CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       isodow(d) >= 6 AS is_weekend, d = last_day(d) AS is_month_end,
       (month(d) IN (3, 6, 9, 12) AND d = last_day(d)) AS is_quarter_end,
       (month(d) = 12 AND day(d) = 31) AS is_year_end,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
            WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
       {BATCH} AS batch_id, {TS} AS created_at
FROM days"""


def stringify_sql(table: str, cols) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)


CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
SUPPLIER_COLS = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
EVENTS_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]

DLQ_CTES = f"""
dirty AS ({DIRTY}),
dlq_chk AS (
  SELECT *, CASE WHEN customer_id IS NULL
                 THEN {{'error_type': 'SCHEMA_VALIDATION', 'error_message': {q("customer_id must be integer, got <class 'NoneType'>")}}}
                 WHEN email IS NOT NULL AND NOT contains(email, '@')
                 THEN {{'error_type': 'SCHEMA_VALIDATION', 'error_message': 'Invalid email format: ' || email}} END AS e
  FROM dirty),
dlq_bad AS (
  SELECT 'customer' AS source_table, 'pagila' AS source_system, {BATCH} AS batch_id,
         to_json({json_obj(FIELDS)}) AS raw_record, e.error_type AS error_type, e.error_message AS error_message,
         ff AS failed_field, et AS expected_type,
         substr(CASE ff WHEN 'customer_id' THEN coalesce(customer_id, 'None') WHEN 'email' THEN coalesce(email, 'None')
                        WHEN 'first_name' THEN coalesce(first_name, 'None') WHEN 'last_name' THEN coalesce(last_name, 'None')
                        ELSE 'N/A' END, 1, 500) AS actual_value
  FROM (SELECT *,
               CASE WHEN contains(e.error_message, 'customer_id') THEN 'customer_id'
                    WHEN contains(e.error_message, 'email') THEN 'email'
                    WHEN contains(e.error_message, 'first_name') THEN 'first_name'
                    WHEN contains(e.error_message, 'last_name') THEN 'last_name' END AS ff,
               CASE WHEN contains(lower(e.error_message), 'integer') THEN 'integer'
                    WHEN contains(lower(e.error_message), 'email') THEN 'email_format'
                    WHEN contains(lower(e.error_message), 'date') THEN 'date' END AS et
        FROM dlq_chk WHERE e IS NOT NULL))
"""


def rule_report(rules) -> str:
    cols = ["br_customer_key"]
    for f, arms, value in rules:
        e = case_of([(f, arms, value)])
        cols += [f"{f} AS {f}_raw", f"{value} AS {f}_value",
                 f"struct_extract({e}, 'category') AS {f}_category",
                 f"struct_extract({e}, 'message') AS {f}_message",
                 f"struct_extract({e}, 'actual_value') AS {f}_actual"]
    return with_customer(f"SELECT {', '.join(cols)} FROM cur")


ORACLE.update({
    # scans / sinks
    "scan_projected": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "scan_table": "SELECT * FROM customer",
    "scan_query": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'",
    "scan_partitioned": "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem",
    "param_query": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000.0",
    "sink_append_roundtrip": f"SELECT *, {BATCH} AS batch_id FROM customer UNION ALL SELECT *, {BATCH2} AS batch_id FROM customer",
    "sink_replace_roundtrip": "SELECT * FROM orders",
    # bronze
    "bronze_lenient": f"SELECT {stringify_sql('customer', CUSTOMER_COLS)} FROM customer",
    "bronze_audit_lenient": f"""
WITH s AS (SELECT {stringify_sql('customer', CUSTOMER_COLS)} FROM customer),
h AS (SELECT *, {sha_sorted(CUSTOMER_COLS)} AS br_record_hash FROM s)
SELECT {', '.join(CUSTOMER_COLS)}, {uuid_sql("'customer'", BATCH, 'c_custkey', 'br_record_hash')} AS br_customer_key,
       {TS} AS br_load_time, 'customer_{C.BATCH_ID}' AS br_source_file, br_record_hash,
       TRUE AS br_is_current, {BATCH} AS br_batch_id
FROM h""",
    "bronze_audit_snapshot": f"""
SELECT *, {TS} AS br_load_time, 'public.part' AS br_source_table, {BATCH} AS br_batch_id, TRUE AS br_is_current,
       {md5_join(PART_COLS)} AS br_record_hash
FROM part""",
    "bronze_audit_sqlserver": f"""
SELECT *, {TS} AS _bronze_loaded_at, 'sqlserver' AS _bronze_source_system, 'dbo' AS _bronze_source_schema,
       'orders' AS _bronze_source_table
FROM orders""",
    "bronze_audit_extended": f"""
WITH s AS (SELECT {stringify_sql('supplier', SUPPLIER_COLS)} FROM supplier)
SELECT *, {TS} AS _bronze_loaded_at, 'sqlserver' AS _bronze_source_system, 'dbo' AS _bronze_source_schema,
       'supplier' AS _bronze_source_table, {BATCH} AS _bronze_batch_id, {sha_sorted(SUPPLIER_COLS)} AS _bronze_row_hash,
       FALSE AS _bronze_is_deleted
FROM s""",
    "record_hash_sha256": f"""
WITH s AS (SELECT {stringify_sql('lineitem', LINEITEM_COLS)} FROM lineitem)
SELECT l_orderkey, l_linenumber, {sha_sorted(LINEITEM_COLS)} AS record_hash FROM s""",
    "record_hash_md5": f"SELECT p_partkey, {md5_join(PART_COLS)} AS record_hash FROM part",
    "surrogate_key": f"SELECT c_custkey, {uuid_sql(chr(39) + 'customer' + chr(39), BATCH, 'c_custkey', md5_join(CUSTOMER_COLS))} AS surrogate_key FROM customer",
    "bronze_typed_conform": """
WITH s AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
                  CAST(o_orderstatus AS VARCHAR) AS o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
                  CAST(o_orderdate AS VARCHAR) AS o_orderdate, CAST(o_orderpriority AS VARCHAR) AS o_orderpriority
           FROM orders)
SELECT TRY_CAST(o_orderkey AS BIGINT) AS o_orderkey, TRY_CAST(o_custkey AS BIGINT) AS o_custkey,
       coalesce(o_orderstatus, 'O') AS o_orderstatus,
       coalesce(TRY_CAST(o_totalprice AS DECIMAL(12,2)), CAST('0.00' AS DECIMAL(12,2))) AS o_totalprice,
       TRY_CAST(o_orderdate AS TIMESTAMP) AS source_o_orderdate,
       coalesce(o_orderpriority, '5-LOW') AS o_orderpriority
FROM s""",
    "column_overrides": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""",
    # DLQ
    "dlq_good": f"""WITH {DLQ_CTES}
SELECT {', '.join(FIELDS)}, {TS} AS br_load_time, 'customer_{C.BATCH_ID}' AS br_source_file, {BATCH} AS br_batch_id,
       TRUE AS br_is_current, {uuid_sql("'customer'", BATCH, 'customer_id', sha_sorted(FIELDS))} AS br_customer_key
FROM dlq_chk WHERE e IS NULL""",
    "dlq_bad": f"WITH {DLQ_CTES} SELECT * FROM dlq_bad",
    "dlq_record": f"""WITH {DLQ_CTES}
SELECT {uuid_sql("'dlq'", 'source_table', 'batch_id', 'raw_record')} AS error_id, *, 'PENDING' AS remediation_status,
       CAST(NULL AS VARCHAR) AS remediation_notes, {TS} AS created_at, 0 AS retry_count
FROM dlq_bad""",
    "dlq_extract": f"WITH {DLQ_CTES} SELECT error_message, failed_field, expected_type, actual_value FROM dlq_bad",
    "dlq_summary": f"""WITH {DLQ_CTES}
SELECT 1 AS tables_processed, count(*) AS records_processed, count_if(e IS NULL) AS records_success,
       count_if(e IS NOT NULL) AS records_failed,
       round(CASE WHEN count(*) > 0 THEN count_if(e IS NULL) / count(*) * 100 ELSE 0.0 END, 2) AS success_rate,
       count_if(e IS NOT NULL) > 0 AS has_errors
FROM dlq_chk""",
    # silver
    "silver_current": with_customer("SELECT * FROM cur"),
    "v_required_int": rule_report([r_required_int("customer_id"), r_required_int("store_id")]),
    "v_required_string": rule_report([r_required_string("first_name"), r_required_string("last_name")]),
    "v_email": rule_report([r_email("email")]),
    "v_optional_int": rule_report([r_optional_int("address_id")]),
    "v_boolean_like": rule_report([r_bool_like("activebool")]),
    "v_iso_datetime": rule_report([r_iso_datetime("create_date"), r_iso_datetime("last_update")]),
    "v_flag01": rule_report([r_flag01("active")]),
    "silver_first_failure": with_customer("""
SELECT br_customer_key, err IS NULL AS is_valid, err.category AS error_category, err.failed_field AS failed_field,
       err.message AS error_message, err.actual_value AS actual_value FROM validated"""),
    "silver_clean": with_customer("SELECT * FROM silver"),
    "silver_quarantine": with_customer("SELECT * FROM quarantine"),
    "silver_stats": with_customer("""
SELECT 'sl_customer' AS table_name, count(*) AS records_processed, count_if(err IS NULL) AS records_promoted,
       count_if(err IS NOT NULL) AS records_quarantined,
       CASE WHEN count(*) > 0 THEN count_if(err IS NULL) / count(*) * 100 ELSE 0.0 END AS success_rate
FROM validated"""),
    "silver_promote_generic": f"""
SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_totalprice, o_orderdate,
       {uuid_sql("'sl_orders'", BATCH, 'o_orderkey')} AS sl_orders_key, o_orderkey AS br_source_key,
       {TS} AS sl_load_time, {BATCH} AS sl_batch_id
FROM orders
WHERE o_orderstatus IN ('F', 'O', 'P') AND o_totalprice > 0
  AND CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'""",
    "silver_derive": with_customer(f"""
SELECT sl_customer_key, customer_id, concat_ws(' ', first_name, last_name) AS full_name,
       CASE WHEN contains(email, '@') THEN split_part(email, '@', 2) END AS email_domain,
       CAST(date_diff('day', CAST(create_date AS DATE), DATE '{C.AS_OF_DATE}') AS INTEGER) AS customer_tenure_days,
       coalesce(email IS NOT NULL AND contains(email, '@') AND contains(split_part(email, '@', 2), '.'), FALSE)
         AS is_email_valid,
       'pagila' AS sl_source_system,
       CAST((CAST(email IS NOT NULL AS INTEGER) + CAST(address_id IS NOT NULL AS INTEGER)
             + CAST(create_date IS NOT NULL AS INTEGER) + CAST(last_update IS NOT NULL AS INTEGER)) AS DOUBLE) / 4
         AS sl_data_quality_score
FROM silver"""),
    # gold
    "dim_customer": with_customer("SELECT * FROM dim"),
    "customer_segment": with_customer(f"SELECT customer_id, email, first_name, last_name, {segment_sql()} AS customer_segment FROM silver"),
    "email_domain": with_customer(f"SELECT customer_id, email, {domain_sql()} AS email_domain FROM silver"),
    "name_length_bucket": with_customer(f"SELECT customer_id, first_name, last_name, {bucket_sql()} AS name_length_category FROM silver"),
    "dim_date": dim_date_sql(),
    "dim_date_flags": f"""WITH {DATE_DAYS}
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, isodow(d) >= 6 AS is_weekend, d = last_day(d) AS is_month_end,
       (month(d) IN (3, 6, 9, 12) AND d = last_day(d)) AS is_quarter_end, (month(d) = 12 AND day(d) = 31) AS is_year_end,
       {LEGACY_MONTH_END} AS compat_is_month_end,
       (month(d) IN (3, 6, 9, 12) AND {LEGACY_MONTH_END}) AS compat_is_quarter_end
FROM days""",
    "kpi_customer_summary": with_customer("SELECT * FROM kpi"),
    "customer_summary_view": """
SELECT count(*) AS total_orders, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_orders,
       min(o_orderdate) AS first_order_date, max(o_orderdate) AS last_order_date
FROM orders""",
})


# ---------------------------------------------------------------- part 2: layers, catalog, quality, history
ALL_TABLES = list(C.DRIVER_TABLES)
RELATIONAL = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def in_list(names) -> str:
    return "(" + ", ".join(q(n) for n in names) + ")"


def counts_sql(names) -> str:
    return " UNION ALL ".join(f"SELECT {q(t)} AS table_name, count(*) AS row_count FROM {t}" for t in names)


ORACLE["layer_listing"] = f"""WITH {CUSTOMER_CTES}, {DATE_DAYS}
SELECT 'bronze' AS layer, 'br_customer' AS table_name, count(*) AS record_count FROM bronze
UNION ALL SELECT 'silver', 'sl_customer', count(*) FROM silver
UNION ALL SELECT 'silver', 'sl_transformation_errors', count(*) FROM quarantine
UNION ALL SELECT 'gold', 'dim_customer', count(*) FROM dim
UNION ALL SELECT 'gold', 'dim_date', count(*) FROM days
UNION ALL SELECT 'gold', 'kpi_customer_summary', count(*) FROM kpi"""

ORACLE["gold_stats"] = f"""WITH {CUSTOMER_CTES}, {DATE_DAYS},
objs AS (SELECT count(*) AS records FROM dim UNION ALL SELECT count(*) FROM days UNION ALL SELECT count(*) FROM kpi)
SELECT {BATCH} AS batch_id, count(*) AS objects_total, count_if(records > 0) AS objects_processed,
       CAST(sum(records) AS BIGINT) AS total_records_created,
       CASE WHEN count(*) > 0 THEN count_if(records > 0) / count(*) * 100 ELSE 0.0 END AS success_rate
FROM objs"""

ORACLE["layer_row_counts"] = counts_sql(ALL_TABLES)


def _pk_fk_exprs():
    pk = " OR ".join(f"(c.table_name = {q(t)} AND c.column_name = {q(col)})"
                     for t, cols in C.PRIMARY_KEYS.items() for col in cols)
    fk_arms = " ".join(f"WHEN c.table_name = {q(fk.child)} AND c.column_name = {q(cc)} THEN {q(fk.parent + '.' + pc)}"
                       for fk in C.FOREIGN_KEYS for cc, pc in zip(fk.child_cols, fk.parent_cols))
    return f"({pk})", f"CASE {fk_arms} END"


_PK, _FK = _pk_fk_exprs()

ORACLE["table_metadata"] = f"""WITH rc AS ({counts_sql(ALL_TABLES)})
SELECT 'source' AS schema_name, c.table_name, CAST(c.ordinal_position AS INTEGER) AS ordinal_position, c.column_name,
       c.data_type, c.is_nullable = 'YES' AS is_nullable, FALSE AS is_view, {_PK} AS is_primary_key,
       {_FK} AS references_column, rc.row_count
FROM information_schema.columns c JOIN rc ON c.table_name = rc.table_name
WHERE c.table_name IN {in_list(ALL_TABLES)}"""

ORACLE["catalog_columns"] = f"""
SELECT 'source' AS schema_name, c.table_name, CAST(c.ordinal_position AS INTEGER) AS ordinal_position, c.column_name,
       c.data_type, c.is_nullable = 'YES' AS is_nullable, FALSE AS is_view
FROM information_schema.columns c WHERE c.table_name IN {in_list(ALL_TABLES)}"""

_SYS = " AND ".join(f"NOT contains(c.table_name, {q(p)})" for p in ("sys", "INFORMATION_SCHEMA", "tempdb", "msdb"))

ORACLE["discover_tables"] = f"""WITH rc AS ({counts_sql(ALL_TABLES)})
SELECT c.table_name, CAST(count(*) AS INTEGER) AS column_count, rc.row_count
FROM information_schema.columns c JOIN rc ON c.table_name = rc.table_name
WHERE c.table_name IN {in_list(ALL_TABLES)} AND regexp_matches(c.table_name, '(?i)e') AND {_SYS}
GROUP BY c.table_name, rc.row_count"""

ORACLE["select_tables"] = f"""
SELECT DISTINCT c.table_name FROM information_schema.columns c
WHERE c.table_name IN {in_list(ALL_TABLES)} AND {_SYS}
  AND regexp_matches(c.table_name, '(?i)^(customer|orders|lineitem|part|supplier|nation|region)$')
  AND NOT regexp_matches(c.table_name, '(?i)^(region|nation)$')"""

# Candidate key pairs of the relational tables plus documents/labels
# (integer columns named *key / *_id, matched after the table prefix).
FK_GROUPS = [
    [("region", "r_regionkey"), ("nation", "n_regionkey")],
    [("nation", "n_nationkey"), ("customer", "c_nationkey"), ("supplier", "s_nationkey")],
    [("customer", "c_custkey"), ("orders", "o_custkey")],
    [("supplier", "s_suppkey"), ("lineitem", "l_suppkey")],
    [("part", "p_partkey"), ("lineitem", "l_partkey")],
    [("orders", "o_orderkey"), ("lineitem", "l_orderkey")],
    [("documents", "doc_id"), ("labels", "doc_id")],
]


def _fk_pair_sql(ct, cc, pt, pc):
    return f"""SELECT {q(ct)} AS child_table, {q(cc)} AS child_column, {q(pt)} AS parent_table, {q(pc)} AS parent_column,
  (SELECT coalesce(max(n), 1) <= 1 FROM (SELECT count(*) AS n FROM {pt} WHERE {pc} IS NOT NULL GROUP BY {pc})) AS parent_unique,
  (SELECT count(*) FROM {ct} ch WHERE ch.{cc} IS NOT NULL
     AND NOT EXISTS (SELECT 1 FROM {pt} pa WHERE pa.{pc} = ch.{cc})) AS orphan_rows"""


_pairs = [(ct, cc, pt, pc) for g in FK_GROUPS for ct, cc in g for pt, pc in g if ct != pt]
ORACLE["fk_candidates"] = ("SELECT *, parent_unique AND orphan_rows = 0 AS is_foreign_key FROM ("
                           + " UNION ALL ".join(_fk_pair_sql(*p) for p in _pairs) + ") WHERE parent_unique")

_CLASSES = {"BIGINT": "whole", "INTEGER": "whole", "SMALLINT": "whole", "VARCHAR": "text", "DATE": "day", "TIMESTAMP": "time", "BOOLEAN": "truth"}
# columns of the driver tables that can be keys (fractions and arrays left out)
KEYABLE = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"],
           "customer": [c for c in CUSTOMER_COLS if c != "c_acctbal"], "supplier": [c for c in SUPPLIER_COLS if c != "s_acctbal"],
           "part": [c for c in PART_COLS if c != "p_retailprice"], "orders": [c for c in ORDERS_COLS if c != "o_totalprice"],
           "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"],
           "events": [c for c in EVENTS_COLS if c != "value"], "documents": ["doc_id", "text", "lang", "source", "n_chars"], "embeddings": ["vec_id", "label"],
           "pages": ["page_id", "url", "html"], "benchmark": ["item_id", "text"], "labels": ["doc_id", "quality", "toxic"],
           "conversations": ["conv_id", "turn", "role", "text"]}
_CELLS = " UNION ALL ".join(
    f"SELECT {q(t)} AS t, {q(c)} AS c, CASE typeof({c}) " + " ".join(f"WHEN '{k}' THEN '{v}:'" for k, v in _CLASSES.items()) + f" END || CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL"
    for t, cs in KEYABLE.items() for c in cs)
_HELD = f"""cells AS ({_CELLS}), held AS (SELECT t, c, v, count(*) AS n FROM cells GROUP BY ALL),
cols AS (SELECT t, c, count(*) AS n_values, max(n) AS most FROM held GROUP BY ALL)"""
ORACLE["inclusion_dependencies"] = f"""WITH {_HELD},
met AS (SELECT a.t, a.c, b.t AS pt, b.c AS pc, count(*) AS n FROM held a JOIN held b ON a.v = b.v AND (a.t <> b.t OR a.c <> b.c) GROUP BY ALL)
SELECT m.t AS child_table, m.c AS child_column, m.pt AS parent_table, m.pc AS parent_column, k.n_values AS child_values, p.n_values AS parent_values,
       p.most = 1 AS parent_unique
FROM met m JOIN cols k ON k.t = m.t AND k.c = m.c JOIN cols p ON p.t = m.pt AND p.c = m.pc WHERE m.n = k.n_values"""


def _unique_sql(table: str, cols) -> str:
    return (f"SELECT {q(table)} AS table_name, {q(','.join(cols))} AS key_columns, CAST({len(cols)} AS INTEGER) AS n_columns, "
            f"(SELECT count(*) FROM {table}) AS rows, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(cols)} FROM {table} "
            f"WHERE {' AND '.join(c + ' IS NOT NULL' for c in cols)})) AS different")


_TRIED = " UNION ALL ".join(_unique_sql(t, some) for t, cs in KEYABLE.items() for n in (1, 2, 3) for some in combinations(cs, n))
# of two keys the one that holds the other is none of the smallest; three columns only in tables without a smaller key
ORACLE["key_candidates"] = f"""WITH tried AS ({_TRIED}), found AS (SELECT * FROM tried WHERE rows > 0 AND rows = different)
SELECT table_name, key_columns, n_columns FROM found f WHERE NOT EXISTS (SELECT 1 FROM found g WHERE g.table_name = f.table_name
    AND g.n_columns < f.n_columns AND (f.n_columns > 2 OR list_has_all(string_split(f.key_columns, ','), string_split(g.key_columns, ','))))"""

S1 = "SELECT * FROM customer WHERE c_custkey % 10 <> 9"
S2 = ("SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 10 = 3 THEN round(c_acctbal + 100.0, 2) "
      "ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 10 <> 7")
P2 = "SELECT * FROM part WHERE p_partkey % 10 <> 7"
_REG_TABLES = ["customer", "part", "orders", "nation", "supplier"]


def _registry(counts: str, ts: str) -> str:
    return (f"SELECT t.table_name, 'parquet' AS source_system, t.row_count, cj.columns_json, {ts} AS last_ingestion_at, "
            f"md5(CAST(t.row_count AS VARCHAR) || '|' || cj.columns_json) AS content_hash "
            f"FROM ({counts}) t JOIN cj ON t.table_name = cj.table_name")


ORACLE["table_registry_upsert"] = f"""
WITH cj AS (SELECT table_name, '[' || string_agg('{{"name":"' || column_name || '","type":"' || data_type || '"}}', ','
                                                 ORDER BY ordinal_position) || ']' AS columns_json
            FROM information_schema.columns WHERE table_name IN {in_list(_REG_TABLES)} GROUP BY table_name),
old AS ({_registry(f"SELECT 'customer' AS table_name, count(*) AS row_count FROM ({S1}) UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'nation', count(*) FROM nation", TS)}),
new AS ({_registry(f"SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'part', count(*) FROM ({P2}) UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'supplier', count(*) FROM supplier", TS2)})
SELECT coalesce(n.table_name, o.table_name) AS table_name, coalesce(n.source_system, o.source_system) AS source_system,
       coalesce(n.row_count, o.row_count) AS row_count, coalesce(n.columns_json, o.columns_json) AS columns_json,
       coalesce(n.content_hash, o.content_hash) AS content_hash,
       coalesce(n.last_ingestion_at, o.last_ingestion_at) AS last_ingestion_at,
       CASE WHEN o.table_name IS NULL THEN {TS2} ELSE {TS} END AS created_at,
       CASE WHEN n.table_name IS NULL THEN {TS} WHEN o.table_name IS NULL OR o.content_hash <> n.content_hash THEN {TS2}
            ELSE {TS} END AS updated_at
FROM old o FULL OUTER JOIN new n ON o.table_name = n.table_name"""


def _check(check, table, column, failures, **extra):
    cols = [f"{q(check)} AS check_name", f"{q(table)} AS table_name",
            (f"{q(column)}" if column is not None else "CAST(NULL AS VARCHAR)") + " AS column_name",
            f"CAST({failures} AS BIGINT) AS failures", f"CAST({failures} AS BIGINT) = 0 AS ok"]
    cols += [f"{v} AS {k}" for k, v in extra.items()]
    return "SELECT " + ", ".join(cols)


ORACLE["dq_reconcile"] = f"""WITH {CUSTOMER_CTES},
n AS (SELECT (SELECT count(*) FROM dirty) AS src, (SELECT count(*) FROM bronze) AS br,
             (SELECT count(*) FROM bronze WHERE br_is_current) AS brc, (SELECT count(*) FROM silver) AS sl,
             (SELECT count(*) FROM quarantine) AS qu, (SELECT count(*) FROM dim) AS dm)
{_check('source_vs_bronze', 'br_customer', None, 'abs(src - br)', expected='src', actual='br')} FROM n
UNION ALL {_check('bronze_vs_silver_quarantine', 'sl_customer', None, 'abs(brc - (sl + qu))', expected='brc', actual='sl + qu')} FROM n
UNION ALL {_check('silver_vs_dim', 'dim_customer', None, 'abs(sl - dm)', expected='sl', actual='dm')} FROM n"""

ORACLE["dq_duplicates"] = """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLE["dq_sum_match"] = """
WITH per_order AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
                         * (1 + CAST(l_tax AS DECIMAL(18,2)))) AS line_total
  FROM lineitem GROUP BY l_orderkey),
agg AS (
  SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS expected,
         CAST(coalesce(sum(line_total), 0) AS DECIMAL(18,2)) AS actual
  FROM orders o LEFT JOIN per_order p ON o.o_orderkey = p.l_orderkey GROUP BY o_orderstatus)
SELECT 'sum_match' AS check_name, 'orders' AS table_name, o_orderstatus AS column_name, expected, actual,
       CAST(abs(expected - actual) AS DECIMAL(18,2)) AS difference,
       CAST(abs(expected - actual) AS DECIMAL(18,2)) <= CAST('0.01' AS DECIMAL(18,2)) AS ok
FROM agg"""

ORACLE["dq_foreign_keys"] = " UNION ALL ".join(
    _check("foreign_key", fk.child, ",".join(fk.child_cols), "n", parent_table=q(fk.parent),
           parent_column=q(",".join(fk.parent_cols)))
    + f" FROM (SELECT count(*) AS n FROM {fk.child} ch WHERE ch.{fk.child_cols[0]} IS NOT NULL AND NOT EXISTS "
      f"(SELECT 1 FROM {fk.parent} pa WHERE pa.{fk.parent_cols[0]} = ch.{fk.child_cols[0]}))"
    for fk in C.FOREIGN_KEYS)

_AUDIT = ["br_customer_key", "br_load_time", "br_source_file", "br_record_hash", "br_is_current", "br_batch_id"]
ORACLE["dq_audit_populated"] = with_customer(" UNION ALL ".join(
    _check("audit_populated", "br_customer", c, "n") + f" FROM (SELECT count_if({c} IS NULL) AS n FROM bronze)"
    for c in _AUDIT))

_REQ = {"customer": ["c_custkey", "c_name", "c_nationkey", "c_phone"],
        "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
        "events": ["event_id", "ts", "user_id", "event_type"]}
_PRESENT = {"customer": CUSTOMER_COLS, "orders": ORDERS_COLS, "events": EVENTS_COLS}
ORACLE["dq_completeness"] = " UNION ALL ".join(
    (_check("completeness", t, c, "n", column_present="TRUE") + f" FROM (SELECT count_if({c} IS NULL) AS n FROM {t})"
     if c in _PRESENT[t] else
     _check("completeness", t, c, "n", column_present="FALSE") + f" FROM (SELECT count(*) AS n FROM {t})")
    for t, cols in _REQ.items() for c in cols)

ORACLE["dq_uniqueness"] = " UNION ALL ".join(
    _check("uniqueness", t, ",".join(keys), "total_rows - distinct_keys",
           total_rows="total_rows", distinct_keys="distinct_keys")
    + f" FROM (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, count(*) AS distinct_keys "
      f"FROM (SELECT count(*) AS n FROM {t} GROUP BY {', '.join(keys)}))"
    for t, keys in C.PRIMARY_KEYS.items())

_FRESH = [("events", "ts", "2024-02-01 00:00:00", 86400), ("lineitem", "l_shipdate", "2002-01-01 00:00:00", 30 * 86400)]
ORACLE["dq_freshness"] = " UNION ALL ".join(
    _check("freshness", t, c, f"CASE WHEN lag > {lag} THEN 1 ELSE 0 END", latest="latest", lag_seconds="lag")
    + f" FROM (SELECT max({c}) AS latest, (epoch_us(TIMESTAMP '{as_of}') - epoch_us(max({c}))) // 1000000 AS lag FROM {t})"
    for t, c, as_of, lag in _FRESH)

ORACLE["incremental_watermark"] = """
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')"""

_ATTRS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_HCOLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, record_hash"
ORACLE["scd2_apply"] = f"""
WITH hist AS (SELECT *, {md5_join(_ATTRS)} AS record_hash, {TS} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
                     TRUE AS is_current, {BATCH} AS batch_id FROM ({S1})),
inc AS (SELECT *, {md5_join(_ATTRS)} AS record_hash FROM ({S2}))
SELECT h.* FROM hist h LEFT JOIN inc i ON h.c_custkey = i.c_custkey
 WHERE i.c_custkey IS NULL OR i.record_hash = h.record_hash
UNION ALL
SELECT h.c_custkey, h.c_name, h.c_nationkey, h.c_acctbal, h.c_mktsegment, h.record_hash, h.valid_from, {TS2} AS valid_to,
       FALSE AS is_current, h.batch_id
  FROM hist h JOIN inc i ON h.c_custkey = i.c_custkey WHERE i.record_hash <> h.record_hash
UNION ALL
SELECT i.c_custkey, i.c_name, i.c_nationkey, i.c_acctbal, i.c_mktsegment, i.record_hash, {TS2} AS valid_from,
       CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current, {BATCH2} AS batch_id
  FROM inc i LEFT JOIN hist h ON h.c_custkey = i.c_custkey WHERE h.c_custkey IS NULL OR h.record_hash <> i.record_hash"""


def _load(where, batch, ts):
    return (f"SELECT *, {md5_join(EVENTS_COLS)} AS br_record_hash, {uuid_sql(q('events'), batch, 'event_id')} AS br_events_key, "
            f"{ts} AS br_load_time, {batch} AS br_batch_id FROM events WHERE {where}")


ORACLE["dedup_row_hash"] = f"""
WITH loads AS ({_load("ts < TIMESTAMP '2024-01-16 00:00:00'", BATCH, TS)} UNION ALL
               {_load("ts >= TIMESTAMP '2024-01-10 00:00:00'", BATCH2, TS2)})
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id, br_record_hash ORDER BY br_load_time, br_events_key) AS rn FROM loads)
WHERE rn = 1"""

ORACLE["soft_delete_mark"] = f"""
WITH s1 AS (SELECT * FROM customer), s2 AS ({S2})
SELECT s1.*, {BATCH} AS _bronze_batch_id, k.c_custkey IS NULL AS _bronze_is_deleted,
       CASE WHEN k.c_custkey IS NULL THEN {TS2} END AS _bronze_deleted_at
FROM s1 LEFT JOIN (SELECT DISTINCT c_custkey FROM s2) k ON s1.c_custkey = k.c_custkey"""

ORACLE["reference_inactivate"] = f"""
SELECT p.*, k.p_partkey IS NOT NULL AS is_active,
       CASE WHEN k.p_partkey IS NULL THEN DATE '{C.AS_OF_DATE}' END AS inactivated_date,
       CASE WHEN k.p_partkey IS NULL THEN 'reference_sync' END AS inactivated_by
FROM part p LEFT JOIN (SELECT DISTINCT p_partkey FROM ({P2})) k ON p.p_partkey = k.p_partkey"""

_LATE = " UNION ALL ".join(
    f"SELECT c_custkey, c_name, c_nationkey, CASE WHEN {changed.replace('k %', 'c_custkey %')} THEN round(c_acctbal + 100.0, 2) ELSE c_acctbal END AS c_acctbal, "
    f"c_mktsegment, TIMESTAMP '{t}' AS t, '{batch}' AS batch_id FROM customer WHERE NOT ({missing.replace('k %', 'c_custkey %')})"
    for t, batch, missing, changed in FX.LOADS)
# a full rebuild from all snapshots: a version begins where the content differs from the load before that has the key
ORACLE["scd2_late_load"] = f"""
WITH seen AS (SELECT *, {md5_join(_ATTRS)} AS record_hash FROM ({_LATE})),
marked AS (SELECT *, lag(record_hash) OVER (PARTITION BY c_custkey ORDER BY t) AS before FROM seen),
first AS (SELECT * FROM marked WHERE before IS NULL OR before <> record_hash)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, record_hash, t AS valid_from,
       lead(t) OVER (PARTITION BY c_custkey ORDER BY t) AS valid_to,
       lead(t) OVER (PARTITION BY c_custkey ORDER BY t) IS NULL AS is_current, batch_id FROM first"""

_CC = ["c_custkey", *_ATTRS]
ORACLE["cdc_events"] = f"""
WITH o AS (SELECT *, {md5_join(_ATTRS)} AS h FROM ({S1})), n AS (SELECT *, {md5_join(_ATTRS)} AS h FROM ({S2})),
j AS (SELECT o.*, n.c_custkey AS n_key, n.c_name AS n_c_name, n.c_nationkey AS n_c_nationkey, n.c_acctbal AS n_c_acctbal,
             n.c_mktsegment AS n_c_mktsegment, n.h AS n_h
      FROM o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey),
e AS (SELECT *, CASE WHEN c_custkey IS NOT NULL AND n_key IS NOT NULL AND h <> n_h THEN 'U'
                     WHEN c_custkey IS NULL THEN 'I' WHEN n_key IS NULL THEN 'D' END AS operation FROM j)
SELECT 'customer' AS table_name, operation, coalesce(n_key, c_custkey) AS record_key,
       CASE WHEN n_key IS NOT NULL
            THEN to_json({{'c_custkey': n_key, 'c_name': n_c_name, 'c_nationkey': n_c_nationkey, 'c_acctbal': n_c_acctbal, 'c_mktsegment': n_c_mktsegment}})
            ELSE to_json({json_obj(_CC)}) END AS data,
       {TS2} AS event_ts
FROM e WHERE operation IS NOT NULL"""

_replay_extract = ", ".join(f"json_extract_string(bronze_record_json, '$.{f}') AS {f}" for f in FIELDS)
ORACLE["quarantine_replay"] = f"""WITH {CUSTOMER_CTES},
rq AS (SELECT error_id, br_source_key, source_table, target_table, batch_id, retry_count, {_replay_extract} FROM quarantine),
rf AS (SELECT * REPLACE (regexp_replace(customer_id, '^X', '') AS customer_id,
                         regexp_replace(store_id, '\\.0$', '') AS store_id,
                         CASE WHEN active = 'one' THEN '1' ELSE active END AS active) FROM rq),
rv AS (SELECT *, {case_of(CUSTOMER_RULES)} AS err2 FROM rf)
SELECT error_id, br_source_key, source_table, target_table, batch_id,
       CASE WHEN err2 IS NULL THEN 'RESOLVED' ELSE 'PENDING' END AS remediation_status, retry_count + 1 AS retry_count,
       {TS2} AS last_retry_at, err2.category AS error_category, err2.failed_field AS failed_field,
       err2.message AS error_message
FROM rv"""

_REPLAYED = f"""{CUSTOMER_CTES},
rq AS (SELECT error_id, br_source_key, batch_id, error_category, failed_field, {_replay_extract} FROM quarantine),
rf AS (SELECT * REPLACE (regexp_replace(customer_id, '^X', '') AS customer_id, regexp_replace(store_id, '\\.0$', '') AS store_id,
                         CASE WHEN active = 'one' THEN '1' ELSE active END AS active),
              concat_ws(', ', CASE WHEN starts_with(customer_id, 'X') THEN 'customer_id' END, CASE WHEN store_id LIKE '%.0' THEN 'store_id' END,
                        CASE WHEN active = 'one' THEN 'active' END) AS repaired FROM rq),
rv AS (SELECT *, {case_of(CUSTOMER_RULES)} AS err2, {', '.join(f'{v} AS v_{f}' for f, _, v in CUSTOMER_RULES)} FROM rf)"""
ORACLE["replay_promoted"] = f"""WITH {_REPLAYED}
SELECT {', '.join(f'v_{f} AS {f}' for f in FIELDS)}, {uuid_sql("'sl_customer'", "'batch_001.replay_1'", 'br_source_key')} AS sl_customer_key,
       br_source_key, {TS2} AS sl_load_time, 'batch_001.replay_1' AS sl_batch_id FROM rv WHERE err2 IS NULL"""
ORACLE["replay_quarantine"] = f"""WITH {_REPLAYED}
SELECT error_id, br_source_key, batch_id, error_category, failed_field, CASE WHEN err2 IS NULL THEN 'RESOLVED' ELSE 'PENDING' END AS remediation_status,
       1 AS retry_count, {TS2} AS last_retry_at, CASE WHEN err2 IS NULL THEN 'replay replay_1: repaired ' || repaired
       ELSE 'replay replay_1: still ' || err2.category || ' in ' || err2.failed_field END AS remediation_notes,
       CASE WHEN err2 IS NULL THEN {TS2} END AS resolved_at, CASE WHEN err2 IS NULL THEN 'RULE_UPDATE' END AS resolution_method FROM rv"""

ORACLE["quarantine_report"] = with_customer("""
SELECT error_category, failed_field, severity, count(*) AS errors FROM quarantine
GROUP BY error_category, failed_field, severity""")


def _duck(sql: str, **tables) -> str:
    return sql.format(**tables).replace("STRING", "VARCHAR")


# row rules, then the set rules in their order, each over the rows that are sound so far
ORACLE["dlq_classify"] = f"""
WITH batch AS ({_duck(FX.CUSTOMER_BATCH_SQL, customer="customer")}), stored AS ({_duck(FX.STORED_CUSTOMERS_SQL, customer="customer")}),
parents AS (SELECT CAST(address_id AS VARCHAR) AS p, count(*) AS n FROM ({_duck(FX.ADDRESS_PARENTS_SQL, nation="nation")}) GROUP BY ALL),
one AS (SELECT *, CASE WHEN customer_id IS NULL THEN 'SCHEMA_VALIDATION|customer_id must be integer, got <class ''NoneType''>'
    WHEN regexp_matches(customer_id, '^[+-]?[0-9.]+$') AND contains(customer_id, '.') THEN 'SCHEMA_VALIDATION|customer_id must be integer, got <class ''float''>'
    WHEN email IS NOT NULL AND NOT contains(email, '@') THEN 'SCHEMA_VALIDATION|Invalid email format: ' || email
    WHEN length(first_name) > {C.NAME_CHARS} THEN 'CONSTRAINT_VIOLATION|value too long for first_name, at most {C.NAME_CHARS}'
    WHEN TRY_CAST(store_id AS DOUBLE) NOT BETWEEN 1 AND 2 THEN 'CONSTRAINT_VIOLATION|store_id is out of range: ' || store_id END AS e FROM batch),
two AS (SELECT * REPLACE (CASE WHEN e IS NOT NULL THEN e WHEN customer_id IN (SELECT customer_id FROM stored) THEN 'CONSTRAINT_VIOLATION|key is stored already: customer_id=' || customer_id
    WHEN row_number() OVER (PARTITION BY customer_id, e IS NULL) > 1 THEN 'CONSTRAINT_VIOLATION|duplicate key: customer_id=' || customer_id END AS e) FROM one),
three AS (SELECT coalesce(e, CASE WHEN address_id IS NULL THEN NULL WHEN p.n IS NULL THEN 'CONSTRAINT_VIOLATION|no parent for address_id=' || address_id
    WHEN p.n > 1 THEN 'UNKNOWN_ERROR|several parents for address_id=' || address_id END) AS e FROM two LEFT JOIN parents p ON p.p = address_id)
SELECT split_part(e, '|', 1) AS error_type, substr(e, strpos(e, '|') + 1) AS error_message,
    CASE WHEN contains(e, 'customer_id') THEN 'customer_id' WHEN contains(e, 'email') THEN 'email' WHEN contains(e, 'first_name') THEN 'first_name'
    WHEN contains(e, 'last_name') THEN 'last_name' END AS failed_field, count(*) AS failures FROM three WHERE e IS NOT NULL GROUP BY ALL"""

ORACLE["ingest_single"] = ORACLE["bronze_audit_sqlserver"]
ORACLE["medallion_end_to_end"] = ORACLE["layer_listing"].replace("AS record_count", "AS row_count, CAST(0 AS BIGINT) AS checks_failed, TRUE AS run_valid") \
    .replace(", count(*) FROM", ", count(*), 0, TRUE FROM")
ORACLE["stream_quarantine"] = ORACLE["silver_quarantine"]
_NAMES = ("customer", "orders", "part")
_LOG = "SELECT {run} AS run_id, {batch} || ':dbo.' || {t} AS audit_id, 'parquet' AS source_system, 'dbo' AS source_schema, {t} AS source_table, 'bronze.dbo_' || {t} AS target_table, " \
       "{rows} AS rows_processed, {status} AS status, {error} AS error_message, {batch} AS batch_id, {day} AS run_date, {at} AS ingestion_started_at"


def _logged(run: int, place: int, name: str, status: str, error: str = "FALSE") -> str:
    """A table begins two minutes after the one before: each asks the clock at its begin and its end."""
    at = f"({TS} + INTERVAL {run - 1} DAY + INTERVAL {2 * place} MINUTE)"
    rows = f"(SELECT count(*) FROM {name})" if status == "success" else "CAST(NULL AS BIGINT)"
    return _LOG.format(run=q(f"run_{run}"), batch=BATCH, t=q(name), rows=rows, status=q(status), error=error, day=f"CAST({at} AS DATE)", at=at)


ORACLE["run_log"] = " UNION ALL ".join([_logged(1, 0, "customer", "success"), _logged(1, 1, "orders", "broken_off"),
                                        *[_logged(2, k, t, "success") for k, t in enumerate(_NAMES)], _logged(2, 3, "nowhere", "failed", "TRUE")])
ORACLE["target_by_date"] = "SELECT *, DATE '2024-01-02' AS load_date, 'bronze_prod' AS layer FROM orders"
ORACLE["stream_bronze"] = with_customer("SELECT * FROM bronze")
ORACLE["stream_cdc_apply"] = S2
ORACLE["stream_cdc_faults"] = f"""
SELECT *, TIMESTAMP '{C.LAST_LOAD_TS}' AS event_ts, CAST(0 AS BIGINT) AS event_seq,
       CASE WHEN CAST(record_key AS BIGINT) % 30 IN (0, 10) THEN 'unreadable_data' WHEN operation = 'X' THEN 'unknown_operation'
            WHEN data IS NULL THEN 'no_data' ELSE 'no_key' END AS fault
FROM ({FX.UNREADABLE_EVENTS_SQL.format(customer="customer").replace("STRING", "VARCHAR")})"""


# ---------------------------------------------------------------- result types
# DuckDB types count_if as HUGEINT and to_json as JSON; Spark gives bigint
# and string. Wrap every such call in a CAST so the result schemas agree.
def _wrap_calls(sql: str, fname: str, cast_to: str) -> str:
    out, i, n, token = [], 0, len(sql), fname + "("
    while i < n:
        if sql[i] == "'":                       # copy string literals verbatim
            j = i + 1
            while j < n and not (sql[j] == "'" and (j + 1 >= n or sql[j + 1] != "'")):
                j += 2 if sql[j] == "'" else 1
            out.append(sql[i:j + 1])
            i = j + 1
            continue
        prev = sql[i - 1] if i else " "
        if sql.startswith(token, i) and not (prev.isalnum() or prev == "_"):
            depth, j = 0, i + len(fname)
            while j < n:
                ch = sql[j]
                if ch == "'":
                    j += 1
                    while j < n and sql[j] != "'":
                        j += 1
                elif ch == "(":
                    depth += 1
                elif ch == ")":
                    depth -= 1
                    if depth == 0:
                        break
                j += 1
            inner = _wrap_calls(sql[i + len(token):j], fname, cast_to)
            out.append(f"CAST({fname}({inner}) AS {cast_to})")
            i = j + 1
            continue
        out.append(sql[i])
        i += 1
    return "".join(out)


for _k in list(ORACLE):
    ORACLE[_k] = _wrap_calls(_wrap_calls(ORACLE[_k], "count_if", "BIGINT"), "to_json", "VARCHAR")


def _audit_rows(tables) -> str:
    return " UNION ALL ".join(
        f"SELECT '{C.BATCH_ID}:dbo.{t}' AS audit_id, 'parquet' AS source_system, 'dbo' AS source_schema, "
        f"{q(t)} AS source_table, 'bronze.dbo_{t}' AS target_table, count(*) AS rows_processed, 'success' AS status, "
        f"CAST(NULL AS VARCHAR) AS error_message, {BATCH} AS batch_id FROM {t}" for t in tables)


ORACLE["ingest_multi"] = _audit_rows(["customer", "orders", "part"])
ORACLE["run_audit"] = f"""SELECT a.*, (sum(rows_processed) OVER ())::BIGINT AS run_total_rows, true AS run_success
FROM ({ORACLE['ingest_multi']}) a"""
ORACLE["run_audit_json"] = ORACLE["ingest_multi"]
ORACLE["ingest_all"] = _audit_rows(["customer", "lineitem", "orders", "part", "supplier"])
ORACLE["bronze_run"] = " UNION ALL ".join(
    f"SELECT {q(t)} AS source_table, 'br_{t}' AS bronze_table, count(*) AS records, TRUE AS success, "
    f"CAST(NULL AS VARCHAR) AS error, CAST(100.0 AS DOUBLE) AS run_success_rate FROM {t}"
    for t in ["customer", "orders", "part"])
ORACLE["sink_modes"] = " UNION ALL ".join(
    f"SELECT {q(mode)} AS if_exists, 'dbo_nation' AS target_table, {n} AS rows_written, {q(outcome)} AS outcome, "
    f"(SELECT count(*) FROM nation) AS rows_in_target FROM (SELECT 1)"
    for mode, n, outcome in [("append", "(SELECT count(*) FROM nation)", "written"),
                             ("append", "(SELECT count(*) FROM nation)", "written"),
                             ("replace", "(SELECT count(*) FROM nation)", "written"),
                             ("fail", "CAST(0 AS BIGINT)", "rejected")])

"""The customer medallion flow: source -> bronze -> silver -> gold.

``CustomerFlow`` builds every stage lazily from the driver tables, so a
registered query is just one stage's DataFrame; ``run_medallion`` writes
the layers (idempotent per batch id) and reports row counts.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import contracts as C
from ..functions.rules import customer_rules
from ..operators import bronze as B, gold as G, quality as Q, silver as S
from ..sources import sinks
from ..sources.tables import local_frame
from .fixtures import dirty_customers, table


@dataclass
class CustomerFlow:
    spark: SparkSession
    sf_dir: str
    batch_id: str = C.BATCH_ID
    load_ts: str = C.LOAD_TS
    as_of: str = C.AS_OF_DATE

    def source(self) -> DataFrame:
        return dirty_customers(self.spark, self.sf_dir)

    def bronze(self, source: DataFrame | None = None) -> DataFrame:
        src = source if source is not None else self.source()
        return B.audit_lenient(B.stringify(src), "customer", self.batch_id, self.load_ts,
                               key_cols=("customer_id",))

    def validated(self, bronze: DataFrame | None = None) -> DataFrame:
        b = bronze if bronze is not None else self.bronze()
        return S.validate(S.current_rows(b), customer_rules())

    def silver(self, validated: DataFrame | None = None) -> DataFrame:
        v = validated if validated is not None else self.validated()
        return S.clean(v, customer_rules(), "br_customer_key", self.batch_id, self.load_ts)

    def quarantine(self, validated: DataFrame | None = None) -> DataFrame:
        v = validated if validated is not None else self.validated()
        return S.quarantine(v, S.SILVER_CUSTOMER_SOURCE, "br_customer_key", self.batch_id, self.load_ts)

    def dim_customer(self, silver: DataFrame | None = None) -> DataFrame:
        s = silver if silver is not None else self.silver()
        return G.dim_customer(s, self.batch_id, self.load_ts)

    def kpi(self, dim: DataFrame | None = None) -> DataFrame:
        d = dim if dim is not None else self.dim_customer()
        return G.kpi_customer_summary(d, self.as_of, self.batch_id, self.load_ts)

    def dim_date(self, compat: bool = False) -> DataFrame:
        span = G.date_span(table(self.spark, self.sf_dir, "orders"), "o_orderdate")
        return G.dim_date(span, self.batch_id, self.load_ts, compat=compat)


LAYER_TABLES = (
    ("bronze", "br_customer"),
    ("silver", "sl_customer"),
    ("silver", "sl_transformation_errors"),
    ("gold", "dim_customer"),
    ("gold", "dim_date"),
    ("gold", "kpi_customer_summary"),
)


def _read_batch(spark: SparkSession, path: str, batch_col: str, batch_id: str) -> DataFrame:
    """Read one batch partition directly: only that partition's files are
    listed, however many batches the table holds."""
    return spark.read.option("basePath", path).parquet(sinks.batch_path(path, batch_col, batch_id))


class ValidationFailed(RuntimeError):
    """A validate rule of a run found rows lost or doubled. ``run`` is the run, with its ``checks``."""

    def __init__(self, run: dict, failed: list[str]):
        super().__init__(f"batch {run['batch_id']}: failed checks {', '.join(failed)}")
        self.run = run


def run_medallion(spark: SparkSession, sf_dir: str, lake: str, batch_id: str = C.BATCH_ID,
                  load_ts: str = C.LOAD_TS) -> dict:
    """Bronze -> silver (+quarantine) -> gold, each layer written once and
    read back by the next (the gold dimension and KPI both read the written
    silver batch), so lineage is cut at every layer boundary and a
    lost executor only recomputes from the last written layer. Rewriting
    the same batch id replaces that batch's partition only (idempotent).
    Row counts are observed while writing (no extra scans). The run ends with
    the validate stage; a rule that fails raises ``ValidationFailed``."""
    flow = CustomerFlow(spark, sf_dir, batch_id, load_ts)
    paths = {name: f"{lake}/{layer}/{name}" for layer, name in LAYER_TABLES}
    rows = {}
    rows["br_customer"] = sinks.write_batch(flow.bronze(), paths["br_customer"], "br_batch_id", batch_id)
    bronze = _read_batch(spark, paths["br_customer"], "br_batch_id", batch_id)
    validated = flow.validated(bronze)
    # silver, quarantine and the calendar do not depend on each other: run
    # them as concurrent jobs (FAIR pools) instead of one after another
    rows.update(_concurrently({
        "sl_customer": lambda: sinks.write_batch(flow.silver(validated), paths["sl_customer"], "sl_batch_id", batch_id),
        "sl_transformation_errors": lambda: sinks.write_batch(
            flow.quarantine(validated), paths["sl_transformation_errors"], "batch_id", batch_id),
        "dim_date": lambda: sinks.write_batch(flow.dim_date(), paths["dim_date"], "batch_id", batch_id),
    }, spark))
    silver = _read_batch(spark, paths["sl_customer"], "sl_batch_id", batch_id)
    # the dimension is a narrow projection of silver, so the KPI aggregates
    # that projection of the written silver batch directly: both gold
    # writes start together instead of the KPI waiting for the dimension
    dim = flow.dim_customer(silver)
    rows.update(_concurrently({
        "dim_customer": lambda: sinks.write_batch(dim, paths["dim_customer"], "batch_id", batch_id),
        "kpi_customer_summary": lambda: sinks.write_batch(flow.kpi(dim), paths["kpi_customer_summary"],
                                                          "batch_id", batch_id),
    }, spark))
    run = {"paths": paths, "rows": rows, "batch_id": batch_id}
    return validated_run(spark, sf_dir, run)


def validated_run(spark: SparkSession, sf_dir: str, run: dict) -> dict:
    """The run with its ``checks``, evaluated once: one row per rule, handed on as a local frame. Raises ``ValidationFailed``."""
    checks = validate_layers(spark, sf_dir, run)
    rows = checks.collect()   # one row per rule
    run["checks"] = local_frame(spark, rows, checks.schema)
    failed = [r.check_name for r in rows if not r.ok]
    run["valid"] = not failed
    if failed:
        raise ValidationFailed(run, failed)
    return run


def layer_frames(spark: SparkSession, paths: dict, batch_id: str = C.BATCH_ID) -> dict:
    """(layer, table) -> the stored rows of one batch."""
    batch_col = {"br_customer": "br_batch_id", "sl_customer": "sl_batch_id"}
    return {(layer, name): _read_batch(spark, paths[name], batch_col.get(name, "batch_id"), batch_id)
            for layer, name in LAYER_TABLES}


RECONCILE_RULES = (
    ("source_vs_bronze", "br_customer", ["source"], ["br_customer"]),
    ("bronze_vs_silver_quarantine", "sl_customer", ["bronze_current"], ["sl_customer", "sl_transformation_errors"]),
    ("silver_vs_dim", "dim_customer", ["sl_customer"], ["dim_customer"]),
)


def validate_layers(spark: SparkSession, sf_dir: str, run: dict) -> DataFrame:
    """The validate stage: row counts of the source and of the layers as
    they are stored, read back and reconciled. A row lost or doubled
    between two layers fails its rule."""
    stored = {name: df for (_, name), df in layer_frames(spark, run["paths"], run["batch_id"]).items()}
    named = {"source": CustomerFlow(spark, sf_dir).source(), "br_customer": stored["br_customer"],
             "bronze_current": stored["br_customer"].filter(F.col("br_is_current")),
             "sl_customer": stored["sl_customer"], "sl_transformation_errors": stored["sl_transformation_errors"],
             "dim_customer": stored["dim_customer"]}
    return Q.reconcile(named, RECONCILE_RULES)


def _concurrently(jobs: dict, spark: SparkSession) -> dict:
    """Run independent write jobs from a thread pool, each thread in its own
    FAIR scheduler pool; the first failure is raised after all finish."""
    def run(name, job):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"medallion_{name}")
        try:
            return job()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(run, name, job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def run_summary(spark: SparkSession, run: dict) -> DataFrame:
    """(layer, table_name, row_count, checks_failed, run_valid): counts observed at write time, and of each table the rules of the
    validate stage that failed, with the verdict on the whole run."""
    failed = {}
    for r in run["checks"].collect():   # one row per rule
        failed[r.table_name] = failed.get(r.table_name, 0) + (not r.ok)
    return local_frame(spark, [(layer, name, int(run["rows"][name]), failed.get(name, 0), run["valid"]) for layer, name in LAYER_TABLES],
                       "layer string, table_name string, row_count bigint, checks_failed bigint, run_valid boolean")


def layer_summary(spark: SparkSession, paths: dict, batch_id: str = C.BATCH_ID) -> DataFrame:
    """(layer, table_name, row_count) of every layer table for one batch,
    read back from storage — one union of per-table aggregates."""
    parts = []
    for (layer, name), df in layer_frames(spark, paths, batch_id).items():
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

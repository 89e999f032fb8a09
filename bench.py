"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's plan is executed completely with the no-op sink (no result
is pulled to the driver). Every query runs once to warm the JVM and the
code-generation cache, then $BENCH_REPEATS (3) times; the median counts. Prints one JSON line.

usage: python bench.py [--all] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# table_metadata is the metadata harvest (columns, types, keys, row counts of all tables): the one
# operation the reference gives a time for (~10 s for 15 tables).
HEADLINE = ("medallion_end_to_end", "silver_promote_generic", "record_hash_sha256", "dq_foreign_keys", "scd2_apply",
            "table_metadata")

# Input rows each headline query processes (for rows/s): tables it reads, with multiplicity.
INPUT_TABLES = {
    "medallion_end_to_end": {"customer": 1, "orders": 1},
    "silver_promote_generic": {"orders": 1},
    "record_hash_sha256": {"lineitem": 1},
    "dq_foreign_keys": {"region": 1, "nation": 3, "customer": 2, "supplier": 2, "part": 1, "orders": 2, "lineitem": 3},
    "scd2_apply": {"customer": 2},
    "table_metadata": {t: 1 for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                                      "embeddings", "pages", "benchmark", "labels", "conversations")},
}


def main():
    from strata.plans.registry import QUERIES
    from strata.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    names = list(QUERIES) if "--all" in sys.argv else (args or list(HEADLINE))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="strata-bench")

    def run(name):
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    timings = {}
    for name in names:
        run(name)                      # warm-up
        runs = sorted(run(name) for _ in range(repeats))
        timings[name] = round(runs[len(runs) // 2], 3)
    from pyspark.sql import functions as F
    counts = {}
    for name in names:
        for t in INPUT_TABLES.get(name, {}):
            if t not in counts:
                counts[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet").agg(F.count(F.lit(1))).first()[0]
    rows = {n: sum(counts[t] * k for t, k in INPUT_TABLES[n].items()) for n in names if n in INPUT_TABLES}
    rows_per_sec = {n: round(r / timings[n]) for n, r in rows.items() if timings.get(n)}
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_total_seconds" if names == list(HEADLINE) else "total_seconds",
                      "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": sf,
                      "cpus": int(cpus), "rows": rows, "rows_per_sec": rows_per_sec,
                      "timing": f"median of {repeats} runs after one warm-up, noop sink"}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Keys and inclusions from values, the stored run log, storage statistics."""

import datetime as dt
import os
import random
from itertools import combinations

from strata.operators import catalog as CAT, keys as K
from strata.plans import run_log as LOG
from strata.plans.registry import QUERIES
from strata.session import scratch_dir

from .conftest import SF001


def test_keys_and_inclusions_equal_plain_sets(spark):
    rng = random.Random(5)
    rows = {"a": [(k, k // 3, str(k % 7) if k % 5 else None, k % 3) for k in range(60)],
            "b": [(rng.randrange(60), k % 20, None, rng.choice("0123456x")) for k in range(100)],
            "c": [(k // 4, k % 4, k % 2, "s") for k in range(40)], "d": []}
    frames = {t: spark.createDataFrame(r, "w long, x int, y string, z string" if t == "b" else "w long, x int, y string, z long" if t == "a" else "w int, x int, y int, z string")
              for t, r in rows.items()}
    columns = K.columns_of(frames)
    values = {(t, c, kind): [r["wxyz".index(c)] for r in rows[t]] for t, c, kind in columns}
    held = {k: {(k[2], str(x)) for x in v if x is not None} for k, v in values.items()}
    want = {(*a[:2], *b[:2], len(held[a]), len(held[b]), len([x for x in values[b] if x is not None]) == len(held[b]))
            for a in held for b in held if a != b and held[a] and held[a] <= held[b]}
    got = {tuple(r) for r in K.inclusions(frames, scratch_dir(spark, "profile")).collect()}
    assert got == want and want
    keys = set()
    for t in frames:
        found = []
        for n in (1, 2, 3):
            if n == 3 and found:
                break
            for some in combinations("wxyz", n):
                cells = [tuple(r["wxyz".index(c)] for c in some) for r in rows[t]]
                if cells and not any(None in c for c in cells) and len(set(cells)) == len(cells) and not any(set(f) <= set(some) for f in found):
                    found.append(some)
        keys |= {(t, ",".join(f), len(f)) for f in found}
    assert {tuple(r) for r in K.keys(frames, scratch_dir(spark, "profile")).collect()} == keys and ("c", "w,x", 2) in keys


def test_declared_keys_and_relationships_are_found(spark):
    from strata.contracts import FOREIGN_KEYS
    # the given lineitem has pairs of order and line number that come more than once: without those rows it is a key of two columns
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet").dropDuplicates(["l_orderkey", "l_linenumber"])
    assert ("lineitem", "l_orderkey,l_linenumber", 2) in {tuple(r) for r in K.keys({"lineitem": lines}, scratch_dir(spark, "profile")).collect()}
    found = {(r.child_table, r.child_column, r.parent_table, r.parent_column) for r in QUERIES["inclusion_dependencies"](spark, SF001).filter("parent_unique").collect()}
    assert {(f.child, f.child_cols[0], f.parent, f.parent_cols[0]) for f in FOREIGN_KEYS} <= found


def test_few_combinations_are_counted_in_every_row(spark, monkeypatch):
    """Values that come twice in a slice rule most combinations out, without sketches of combinations and without the values of all other columns."""
    rows = [(k, k // 2 * 3, k % 7, k // 700, str(k % 11)) for k in range(7000)]
    t = spark.createDataFrame(rows, "a int, b int, c int, d int, e string")
    tables = {"t": t, "u": t.drop("a").union(t.drop("a").limit(1)), "n": t.selectExpr("IF(a = 5, NULL, a) AS a", "c", "d")}
    expected = {tuple(r) for r in K.keys(tables, scratch_dir(spark, "profile")).collect()}
    # 2k and 2k + 1 of one value of b differ in c, and in d, or not; a row of u comes twice
    assert expected == {("t", "a", 1), *(("t", f"b,{c}", 2) for c in ("c", "e"))}
    monkeypatch.setattr(K, "SLICED_ROWS", 1)
    monkeypatch.setattr(K, "profile", None)
    counted = []
    repeated = K._repeated

    def watched(frames, tried, folder, name, slices=1):
        if slices == 1:
            counted.extend((t, ",".join(c)) for t, c in tried)
        return repeated(frames, tried, folder, name, slices)

    monkeypatch.setattr(K, "_repeated", watched)
    assert {tuple(r) for r in K.keys(tables, scratch_dir(spark, "profile")).collect()} == expected
    assert {x for x in counted if x[0] == "t"} == {(t, c) for t, c, _ in expected} and len(counted) < 10
    some = K._cells(t, [(k, (c,)) for k, c in enumerate("abcde")], 64)
    assert 0 < some.count() < 7000 * 5 / 16 and some.selectExpr("max(pmod(h1, 64))").first()[0] == 0


def test_more_columns_than_bits_of_a_word(spark):
    wide = spark.range(5).selectExpr(*[f"id + {k} AS c{k}" for k in range(70)])
    got = {(r.child_column, r.parent_column) for r in K.inclusions({"t": wide, "u": wide.selectExpr("c69 AS last")}, scratch_dir(spark, "profile")).collect()}
    assert got == {("last", "c69"), ("c69", "last")}


def test_log_states(spark):
    day = dt.datetime(2024, 1, 1)
    path = scratch_dir(spark, "log")
    assert LOG.states(LOG.events(spark, path), day).count() == 0

    def entry(table, status, begin, end=None):
        return (f"b:{table}", "s", "dbo", table, "t", begin, end, None, 1 if end else None, status, None, "b")

    one, two, three = (LOG.RunLog(spark, path, r) for r in ("r1", "r2", "r3"))
    for k, t in enumerate(("x", "y")):
        one.append([entry(t, "running", day + dt.timedelta(minutes=k))], day + dt.timedelta(minutes=k))
    one.append([entry("x", "success", day, day)], day)                                      # begun and finished in one instant
    two.append([entry("y", "running", day + dt.timedelta(hours=1))], day + dt.timedelta(hours=1))
    two.append([entry("y", "failed", day, day + dt.timedelta(hours=2))], day + dt.timedelta(hours=2))
    three.append([entry("z", "running", day + dt.timedelta(days=1))], day + dt.timedelta(days=1))

    def states(as_of):
        return {(r.run_id, r.source_table): r.status for r in LOG.states(LOG.events(spark, path), as_of).collect()}

    known = {("r1", "x"): "success", ("r1", "y"): "broken_off", ("r2", "y"): "failed"}      # overtaken by the run after it
    assert states(day + dt.timedelta(days=1, hours=1)) == known | {("r3", "z"): "running"}
    assert states(day + dt.timedelta(days=2)) == known | {("r3", "z"): "broken_off"}          # silent for too long
    recent = LOG.events(spark, path, since=dt.date(2024, 1, 2))
    assert recent.count() == 1 and "PartitionFilters: [isnotnull(run_date" in recent._jdf.queryExecution().executedPlan().toString()


def test_storage_equals_the_file_system(spark):
    got = {r.table_name: (r.n_files, r.size_bytes) for r in QUERIES["table_storage"](spark, SF001).collect()}
    assert got == {t.removesuffix(".parquet"): (1, os.path.getsize(f"{SF001}/{t}")) for t in os.listdir(SF001)}
    row = QUERIES["table_registry_storage"](spark, SF001).filter("table_name = 'orders'").first()
    assert (row.n_files, row.size_bytes) == got["orders"] and row.connection_text.endswith("PWD=***;")
    masked = spark.range(1).select(CAT.masked("Server=a; Password = x y ;Token=t").alias("m")).first().m
    assert masked == "Server=a; Password=***;Token=***"

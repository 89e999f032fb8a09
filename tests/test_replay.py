"""Replays that are stopped between their writes, repeated, and followed by another one."""

import pytest

from strata import contracts as C
from strata.functions.rules import customer_rules
from strata.operators import quarantine as QR
from strata.plans import replay as R
from strata.plans.medallion import run_medallion
from strata.session import scratch_dir

from .conftest import SF001


def _tables(spark, lake):
    errors = sorted((tuple(r) for r in spark.read.parquet(f"{lake}/{R.ERRORS}").collect()), key=repr)
    silver = sorted((tuple(r) for r in spark.read.parquet(f"{lake}/silver/sl_customer").collect()), key=repr)
    return errors, silver


def _replay(spark, lake, replay_id, fixes):
    return R.replay_batch(spark, lake, C.BATCH_ID, replay_id, list(C.CUSTOMER_FIELDS), fixes, customer_rules(), C.NEXT_LOAD_TS)


@pytest.mark.parametrize("broken", [None, "sl_batch_id", "batch_id"])
def test_a_replay_can_be_stopped_at_any_write(spark, monkeypatch, broken):
    lake = scratch_dir(spark, "lake")
    run_medallion(spark, SF001, lake)
    n_errors, n_silver = (len(x) for x in _tables(spark, lake))
    write, seen = R.sinks.write_batch, []

    def stopping(df, path, batch_col, batch_id, fmt="parquet"):
        seen.append(path)
        if broken == batch_col and len(seen) > 1:   # the staging went through
            raise RuntimeError("stopped")
        return write(df, path, batch_col, batch_id, fmt)

    if broken:
        monkeypatch.setattr(R.sinks, "write_batch", stopping)
        with pytest.raises(RuntimeError):
            _replay(spark, lake, "r1", QR.default_fixes())
        monkeypatch.setattr(R.sinks, "write_batch", write)
    done = _replay(spark, lake, "r1", QR.default_fixes())
    errors, silver = _tables(spark, lake)
    assert 0 < done["promoted"] < n_errors == done["quarantine"] == len(errors) and len(silver) == n_silver + done["promoted"]
    assert _replay(spark, lake, "r1", QR.default_fixes()) == done and _tables(spark, lake) == (errors, silver)
    stored = spark.read.parquet(f"{lake}/{R.ERRORS}")
    status = {r.remediation_status: r["count"] for r in stored.groupBy("remediation_status").count().collect()}
    assert status == {"RESOLVED": done["promoted"], "PENDING": n_errors - done["promoted"]}
    # another replay tries only what is pending, and repairs nothing new
    assert _replay(spark, lake, "r2", QR.default_fixes())["promoted"] == 0
    counts = {(r.remediation_status, r.retry_count) for r in spark.read.parquet(f"{lake}/{R.ERRORS}").collect()}
    assert counts == {("RESOLVED", 1), ("PENDING", 2)}

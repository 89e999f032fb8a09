"""Naming patterns as layers, tables and partitions."""

import pytest

from strata.operators import bronze as B
from strata.session import scratch_dir
from strata.sources import sinks


@pytest.mark.parametrize("pattern, env, want", [
    ("{schema}_{table}", None, ("bronze", "dbo_orders", False)), ("bronze.{schema}_{table}_{date}", None, ("bronze", "dbo_orders", True)),
    ("bronze_{env}.{schema}_{table}", "prod", ("bronze_prod", "dbo_orders", False)), ("raw.{date}_{table}", None, ("raw", "orders", True)),
    ("{table}_{date}_{env}", "dev", ("bronze", "orders_dev", True))])
def test_patterns(pattern, env, want):
    t = B.resolve_target(pattern, "dbo", "orders", env)
    assert (t.layer, t.table, t.by_date) == want


@pytest.mark.parametrize("pattern, schema", [("bronze_{env}.{table}", "dbo"), ("{date}.{table}", "dbo"), ("{schema}_{table}", "../x"), ("a.{date}", "dbo")])
def test_patterns_that_name_nothing(pattern, schema):
    with pytest.raises(ValueError):
        B.resolve_target(pattern, schema, "orders")


def test_a_day_is_pruned_and_replaced_alone(spark):
    lake, t = scratch_dir(spark, "targets"), B.resolve_target("bronze_{env}.{table}_{date}", "dbo", "t", "dev")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for k, day in enumerate(days):
        sinks.write_target(spark.range(10 * (k + 1)), lake, t, day)
    assert sinks.write_target(spark.range(5), lake, t, days[1]) == 5
    assert [r["count"] for r in sinks.read_target(spark, lake, t).groupBy("load_date").count().orderBy("load_date").collect()] == [10, 5, 30]
    one = sinks.read_target(spark, lake, t, since=days[1], until=days[1])
    assert one.count() == 5 and one.schema["load_date"].dataType.typeName() == "date"
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan and "PushedFilters: []" in plan
    for target, day in ((t, None), (B.resolve_target("{table}", "dbo", "t"), days[0])):
        with pytest.raises(ValueError):
            sinks.write_target(spark.range(1), lake, target, day)

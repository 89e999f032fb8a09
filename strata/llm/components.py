"""Connected components over edges, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.llm.store import kept


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected ``edges`` (a, b): the smallest node it can reach.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked to the node's smallest
    neighbour (large star), then every smaller one (small star); the rounds needed grow with the logarithm of the
    component size. Minima are aggregates that combine before the shuffle, and a hub's edges meet its minimum in a join that can be
    split, so no group is gathered. Each round is written to shared storage. Self-loops, repeated edges and nulls are
    ignored."""
    links = edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("u <> v").distinct()
    links = kept(links, "components")
    before = None
    while True:
        both = links.union(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        small = large.join(least, F.col("u") == F.col("n")).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        links = kept(small.select("e.v", "e.u").where("u <> v").distinct(), "components")
        now = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    own = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return own.union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""URL filters by temporal list join, in DataFrame operations.

List entries are dated: a pattern is added to or removed from a list on some day. Per list and pattern they become validity
intervals, from an addition to the next entry. A capture is looked up under every pattern that its URL can match (host, each parent
domain, host and each leading part of the path), and an as-of join keeps the entries that were active when it was fetched. The most
specific active entry decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host; null if there is none."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def patterns(url: Column) -> Column:
    """Every pattern that matches the URL: the host and its parent domains, and the host with each leading part of its path."""
    name = host(url)
    labels = F.split(name, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    paths = F.transform(steps, lambda _, i: F.concat(name, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i + 1), "/")))
    return F.when(name.isNotNull(), F.array_distinct(F.concat(domains, paths)))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) from entries (list, pattern, action, at): from an ``add`` up to the next entry of the
    same list and pattern, open if there is none. Of entries of one moment a ``remove`` wins; repeated entries count once; entries with a null
    are ignored."""
    one = (entries.where("list is not null and pattern is not null and action in ('add', 'remove') and at is not null")
           .groupBy("list", "pattern", "at").agg(F.max("action").alias("action")))  # 'remove' is the larger word
    upto = F.lead("at").over(Window.partitionBy("list", "pattern").orderBy("at"))  # one row per moment
    return one.withColumn("valid_to", upto).where("action = 'add'").select("list", "pattern", F.col("at").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """All columns of ``captures`` and n_active (matching entries active at fetch time), decided_by (pattern), decided_list and blocked.

    The longest active pattern decides, on equal length the ``block`` list before others, then the larger pattern and list name; its list being
    ``block`` blocks. A capture without active entry, with a null or unreadable URL or a null time has 0, null, null and false.
    Result names replace columns of ``captures``; repeated captures are evaluated alike. The lookup joins on the pattern; both sides
    are plain shuffles, so a hot host's partition is split by the adaptive skew join."""
    results = ["n_active", "decided_by", "decided_list", "blocked"]
    mine = captures.select(*[F.col(f"`{c}`") for c in captures.columns if c not in results])
    seen = mine.select(F.col(f"`{url_col}`").alias("u"), F.col(f"`{time_col}`").alias("t")).where("u is not null and t is not null").distinct()
    asked = seen.select("u", "t", F.explode(patterns(F.col("u"))).alias("asked"))
    active = asked.join(intervals(entries), (F.col("asked") == F.col("pattern")) & (F.col("valid_from") <= F.col("t"))
                        & (F.col("valid_to").isNull() | (F.col("t") < F.col("valid_to"))))
    order = F.struct(F.length("pattern").alias("size"), (F.col("list") == "block").alias("b"), "pattern", "list")
    verdict = active.groupBy(F.col("u").alias("__u"), F.col("t").alias("__t")).agg(F.count("*").alias("__n"), F.max(order).alias("__d"))
    out = mine.join(verdict, (F.col(f"`{url_col}`") == F.col("__u")) & (F.col(f"`{time_col}`") == F.col("__t")), "left")
    return out.select(*mine.columns, F.coalesce("__n", F.lit(0)).alias("n_active"), F.col("__d.pattern").alias("decided_by"),
                      F.col("__d.list").alias("decided_list"), F.coalesce(F.col("__d.b"), F.lit(False)).alias("blocked"))

"""Not-modified revisit records of web archives, resolved by an as-of join.

A revisit record tells that a fetch was answered "not modified"; the content is that of an earlier full response. Each one is joined to the
latest earlier full response of its canonical URL; the validators must agree, and the revisit's headers that a not-modified
answer may update are merged into the stored ones.

The as-of join works in two steps, so that a URL fetched very often is never one task: the latest response of each (URL,
day) is carried to the following days over that small table, and within a day a window looks back over that day's records only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Headers that describe the stored message or one connection, which a not-modified answer does not update (fixed values).
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
              "proxy-authenticate", "proxy-authorization", "set-cookie", "te", "trailer", "transfer-encoding", "upgrade")


def canonical(url: Column) -> Column:
    """The URL without scheme, fragment, ``www.``, default port, ``utm_`` parameters and slashes at its end; host in lower case."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    name = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    rest = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*(.*)$", 1), "[?&]utm_[a-z]+=[^&]*", "")
    rest = F.regexp_replace(F.regexp_replace(rest, "^([^?&]*)&", "$1?"), "/+$", "")
    return F.concat(F.regexp_replace(F.regexp_replace(name, r"^www\.", ""), ":(80|443)$", ""), rest)


def resolve(records: DataFrame, not_merged: tuple[str, ...] = NOT_MERGED) -> DataFrame:
    """Records with status, refers_to, digest and headers filled in.

    ``records``: record_id, url, at (timestamp or date), kind ('response' or 'revisit'), etag, last_modified, headers (map of lower-case
    names), digest; other columns are kept, unless named like a result. status: 'full' for a response; for a revisit 'resolved',
    'validator_mismatch' (neither a weak comparison of entity tags nor, without a tag in the revisit, of Last-Modified agrees), 'no_validator' (it
    has neither), 'no_response' (no earlier response, or no URL or time); null for other kinds. Resolved revisits get the response's
    digest, its id in ``refers_to`` and the merged headers; others keep their own. Earlier is a smaller ``at``; of responses of one moment the
    one with the largest id, then digest, counts. Repeated records are resolved alike."""
    mine = records.select(*[F.col(f"`{c}`") for c in records.columns if c not in ("status", "refers_to")])
    headers = F.array_sort(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>"))))
    answer = F.struct("at", "record_id", "digest", "etag", "last_modified", headers.alias("h"))
    rows = mine.select("*", canonical(F.col("url")).alias("__url"), F.to_date("at").alias("__day"),
                       F.when((F.col("kind") == "response") & F.col("at").isNotNull(), answer).alias("__own"))
    # repeated fetches combine before the shuffle; one row per URL and day
    days = rows.where("__own is not null and __url is not null").groupBy("__url", "__day").agg(F.max("__own").alias("__last"))
    before = Window.partitionBy("__url").orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    asked = rows.where("__url is not null and __day is not null").select("__url", "__day").distinct()
    carried = asked.join(days, ["__url", "__day"], "left").withColumn("__carry", F.max("__last").over(before)).select("__url", "__day", "__carry")
    same_day = Window.partitionBy("__url", "__day").orderBy(F.unix_micros(F.col("at").cast("timestamp"))).rangeBetween(Window.unboundedPreceding, -1)
    seen = rows.where("__url is not null and __day is not null").withColumn("__today", F.max("__own").over(same_day))
    seen = seen.join(carried, ["__url", "__day"], "left").withColumn("__r", F.coalesce("__today", "__carry"))
    seen = seen.select(*mine.columns, "__r").unionByName(
        rows.where("__url is null or __day is null").select(*mine.columns, F.lit(None).cast(seen.schema["__r"].dataType).alias("__r")))
    weak = lambda tag: F.regexp_replace(tag, "^W/", "")
    r = F.col("__r")
    agrees = F.when(F.col("etag").isNotNull(), F.coalesce(weak(F.col("etag")) == weak(r["etag"]), F.lit(False))).otherwise(
        F.coalesce(F.col("last_modified") == r["last_modified"], F.lit(False)))
    status = (F.when(F.col("kind") == "response", "full").when(F.col("kind") != "revisit", None).when(F.col("kind").isNull(), None)
              .when(r.isNull(), "no_response").when(F.col("etag").isNull() & F.col("last_modified").isNull(), "no_validator")
              .when(agrees, "resolved").otherwise("validator_mismatch"))
    update = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(*not_merged))
    merged = F.map_concat(F.map_filter(F.map_from_entries(r["h"]), lambda k, _: ~F.array_contains(F.map_keys(update), k)), update)
    done = seen.withColumn("status", status)
    ok = F.coalesce(F.col("status") == "resolved", F.lit(False))
    values = {"digest": F.when(ok, r["digest"]).otherwise(F.col("digest")), "headers": F.when(ok, merged).otherwise(F.col("headers"))}
    return done.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in mine.columns], "status", F.when(ok, r["record_id"]).alias("refers_to"))

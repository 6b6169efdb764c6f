"""Not-modified revisits of a web archive, resolved to the response that they confirm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash128, materialize, need, positional

#: Header fields of a 304 that don't replace stored ones: they describe the message or the connection, not the resource.
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-location", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
#: Query parameters that name a campaign or referrer, not a page.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, www, default port, fragment, tracking parameters and final slash; parameters in order.

    Null stays null.
    """
    rest = F.regexp_replace(F.regexp_replace(F.btrim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^([^/?]*)", 1)), r"^www[0-9]*\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(rest, "[?](.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def _strong(tag: Column) -> Column:
    """An entity tag for weak comparison: without the mark of weakness."""
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url (canonical), outcome, target_id, headers.

    records: record_id (long), kind ("response" with status 200 or "revisit"),
    url, ts (long), status (int), etag, last_modified (strings), headers
    (array<struct<name, value>>, names in lower case).  Other columns are ignored, other
    kinds and statuses take no part.

    The target is the response of the same canonical URL with the greatest ts below the
    revisit's (of equals, the greatest record_id).  `outcome` is "resolved", "none" (no
    such response, or a null URL or ts), or "changed": a validator of the revisit differs from
    the target's, by the tag if both have one, else by the date; without any
    common validator it is "unchecked" and counts as not resolved.  Headers of a resolved revisit
    are the target's, replaced by the revisit's where permitted; else null.

    Every revisit row gives one row: repeated rows, shared ids and a null id are resolved row by row, by
    URL and time.  Of responses that share URL, ts and record_id one takes part, that of the greatest
    validators and headers.  No rows, or no revisits, give an empty table.  Extra columns play no part,
    whatever their names.

    Records are dealt by ranges of (URL, ts), so captures of one URL spread over as many
    tasks as they need.  Within a range a window finds the target; what a range begins
    without comes from the last response of the ranges before, one row per URL and range.
    Only keys move; validators and headers are joined to the pairs found.
    """
    need(records, "record_id", "kind", "url", "ts", "status", "etag", "last_modified", "headers")
    frame, at = positional(records)
    records = frame.select(*(F.col(at[c]).alias(c) for c in ("record_id", "kind", "url", "ts", "status", "etag", "last_modified", "headers")))
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False))
    h1, h2 = hash128(F.col("url"))
    ours = records.where(full | (F.col("kind") == "revisit")).select("record_id", F.col("ts").cast("long").alias("ts"), "etag", "last_modified", "headers", canonical_url(F.col("url")).alias("url"), full.alias("full"))
    ours = ours.withColumn("u1", h1).withColumn("u2", h2)
    slim = ours.where("url is not null and ts is not null").select("record_id", "ts", "full", "u1", "u2")
    dealt = materialize(slim.repartitionByRange("u1", "u2", "ts").withColumn("part", F.spark_partition_id()), "captures")

    this = F.when(F.col("full"), F.struct("ts", "record_id"))
    before = Window.partitionBy("part", "u1", "u2").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    near = dealt.withColumn("near", F.max(this).over(before)).where("not full")
    lasts = dealt.where("full").groupBy("u1", "u2", "part").agg(F.max(F.struct("ts", "record_id")).alias("last"))
    spans = dealt.select("u1", "u2", "part").distinct()
    earlier = Window.partitionBy("u1", "u2").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.join(lasts, ["u1", "u2", "part"], "left").withColumn("carried", F.max("last").over(earlier)).where("carried is not null").select("u1", "u2", "part", "carried")
    found = near.join(carried, ["u1", "u2", "part"], "left").select("u1", "u2", "ts", "record_id", F.coalesce("near", "carried").alias("_at")).where("_at is not null")
    # the same for all revisit rows of one URL, time and id
    found = found.distinct().select(F.col("u1").alias("_u1"), F.col("u2").alias("_u2"), F.col("ts").alias("_ts"), F.col("record_id").alias("_id"), "_at")

    target = ours.where("full and url is not null and ts is not null").groupBy("u1", "u2", "ts", "record_id").agg(F.max(F.struct("etag", "last_modified", "headers")).alias("_t"))
    target = target.select(F.col("u1").alias("t1"), F.col("u2").alias("t2"), F.col("ts").alias("_tts"), F.col("record_id").alias("_tid"), F.col("_t.etag").alias("_etag"), F.col("_t.last_modified").alias("_date"), F.col("_t.headers").alias("_headers"))
    asked = ours.where("not full")
    pairs = asked.join(found, (asked["u1"] == F.col("_u1")) & (asked["u2"] == F.col("_u2")) & (asked["ts"] == F.col("_ts")) & asked["record_id"].eqNullSafe(F.col("_id")), "left")
    pairs = pairs.join(target, (F.col("_u1") == F.col("t1")) & (F.col("_u2") == F.col("t2")) & (F.col("_at.ts") == F.col("_tts")) & F.col("_at.record_id").eqNullSafe(F.col("_tid")), "left")
    pairs = pairs.withColumn("target_id", F.col("_at.record_id"))
    tags = F.col("etag").isNotNull() & F.col("_etag").isNotNull()
    dates = F.col("last_modified").isNotNull() & F.col("_date").isNotNull()
    outcome = (
        F.when(F.col("_at").isNull(), "none")
        .when(tags, F.when(_strong(F.col("etag")) == _strong(F.col("_etag")), "resolved").otherwise("changed"))
        .when(dates, F.when(F.col("last_modified") == F.col("_date"), "resolved").otherwise("changed"))
        .otherwise("unchecked")
    )
    no_headers = F.array().cast("array<struct<name:string,value:string>>")
    mine = F.filter(F.coalesce("headers", no_headers), lambda h: ~F.lower(h["name"]).isin(*NOT_MERGED))
    names = F.transform(mine, lambda h: F.lower(h["name"]))
    stored = F.filter(F.coalesce("_headers", no_headers), lambda h: ~F.array_contains(names, F.lower(h["name"])))
    out = pairs.select("record_id", "url", outcome.alias("outcome"), "target_id", F.concat(stored, mine).alias("headers"))
    return out.withColumn("headers", F.when(F.col("outcome") == "resolved", F.col("headers")))

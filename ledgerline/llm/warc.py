"""WARC not-modified revisits: an as-of join to the latest earlier full response of the same URL.

A revisit record (status 304) has no payload.  It stands for the latest earlier
full response of its canonical URL, if a validator of both agrees: the entity
tag (weak comparison), or the modification time where the revisit has no tag.
The resolved record keeps the response's payload and headers; of the revisit's
headers only those that a 304 response may renew replace the stored ones.

The as-of join sorts records into ranges of (canonical URL, time), so a URL that
holds a third of all records spreads over many ranges.  Within a range the last
response runs forward; across ranges only the last response of each (range, URL)
is carried on, a table whose rows for one URL are at most the number of ranges.
Payloads are never moved.

Defined results
* status ``resolved``: a response was found and a validator agrees;
  ``mismatch``: found, but no validator agrees; ``orphan``: none is earlier;
* a response at the very time of the revisit is not earlier; of responses at the
  same time the largest record id counts;
* null URL or null time: ``orphan``; null headers count as none;
* repeated rows give one result each; an empty table an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Header fields that a 304 response may renew (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that do not name another resource.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)="


def canonical_url(url: Column) -> Column:
    """One spelling for URLs of one resource.

    Scheme, user-visible ``www.``, default port, fragment, tracking parameters
    and a trailing slash are dropped, the host is lower-cased and parameters are
    sorted.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(
        F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    params = F.array_sort(F.filter(
        F.split(F.regexp_extract(bare, r"^[^?]*\??(.*)$", 1), "&"),
        lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&")))
                    .otherwise(F.lit("")))


def weak_tag(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit.

    ``records``: record_id long, url string, ts long, kind string (response or
    revisit), headers map<string,string> with lower-case names, digest string.
    """
    header = lambda c, k: F.element_at(F.coalesce(c, F.create_map().cast("map<string,string>")), k)
    r = records.select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("key"),
        F.col("ts").cast("long").alias("ts"), (F.col("kind") == "response").cast("int").alias("full"),
        F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>")).alias("headers"), "digest")
    r = r.where(F.col("full").isNotNull())

    usable = F.col("key").isNotNull() & F.col("ts").isNotNull()
    order = ["key", "ts", "full", "record_id"]
    ranges = staged(r.where(usable).repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("range", F.spark_partition_id()), "warc")
    response = F.when(F.col("full") == 1, F.struct("ts", "record_id", "headers", "digest"))
    here = Window.partitionBy("range", "key").orderBy("ts", "full", "record_id")
    local = ranges.withColumn("found", F.last(response, ignorenulls=True).over(here)).where("full = 0")

    # the last response of each URL in each range, carried to the later ranges of that URL
    last = ranges.groupBy("range", "key").agg(F.max_by(
        F.struct("ts", "record_id", "headers", "digest"),
        F.when(F.col("full") == 1, F.struct("ts", "record_id"))).alias("last"))
    carried = last.withColumn("carried", F.last("last", ignorenulls=True).over(
        Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)))
    carried = carried.where("carried is not null").select("range", "key", "carried")
    found = (local.join(carried, ["range", "key"], "left")
             .withColumn("found", F.coalesce("found", "carried")).drop("carried", "range"))
    lost = r.where(~usable & (F.col("full") == 0)).withColumn("found", F.lit(None).cast(found.schema["found"].dataType))

    found = found.unionByName(lost.select(*found.columns))
    tag, old_tag = header(F.col("headers"), "etag"), header(F.col("found.headers"), "etag")
    when, old_when = header(F.col("headers"), "last-modified"), header(F.col("found.headers"), "last-modified")
    agrees = F.when(tag.isNotNull(), F.coalesce(weak_tag(tag) == weak_tag(old_tag), F.lit(False))).otherwise(
        F.coalesce(when == old_when, F.lit(False)))
    status = (F.when(F.col("found").isNull(), "orphan").when(agrees, "resolved").otherwise("mismatch"))
    renewed = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter("found.headers", lambda k, _: ~F.map_contains_key(renewed, k))
    merged = F.when(F.col("status") == "resolved", F.array_join(F.transform(
        F.array_sort(F.map_entries(F.map_concat(kept, renewed))),
        lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), "\n"))
    return found.withColumn("status", status).select(
        F.col("record_id").alias("revisit_id"), F.col("key").alias("canonical_url"), "ts", "status",
        F.col("found.record_id").alias("response_id"), F.col("found.ts").alias("response_ts"),
        F.when(F.col("status") == "resolved", F.col("found.digest")).alias("payload_digest"),
        merged.alias("merged_headers"))


#: A page's full capture is at page_id * PERIOD; its re-crawl follows after up to 65,535 seconds.
PERIOD = 60


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl made of the pages: each is captured in full once, and re-crawled later with its validators.

    Pages share canonical URLs, so a re-crawl may meet another page's newer
    response; every fifth tag changes meanwhile, every seventh capture has no tag.
    """
    page = F.col("page_id")
    no_tag = page % 7 == 3
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")), 256)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    p = pages.select(page, "url", digest.alias("digest"), F.when(~no_tag, tag).alias("tag"),
                     F.concat(F.lit("day "), (page % 1000).cast("string")).alias("day"))
    headers = lambda *kv: F.map_filter(F.create_map(*kv), lambda _, v: v.isNotNull())
    first = F.col("page_id") * PERIOD
    again = first + F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 4), 16, 10).cast("long")
    response = p.select(
        (F.col("page_id") * 2).alias("record_id"), "url", first.alias("ts"), F.lit("response").alias("kind"),
        headers(F.lit("etag"), F.col("tag"), F.lit("last-modified"), F.col("day"), F.lit("date"),
                first.cast("string"), F.lit("content-type"), F.lit("text/html")).alias("headers"), "digest")
    revisit = p.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", again.alias("ts"), F.lit("revisit").alias("kind"),
        headers(F.lit("etag"), F.when(F.col("page_id") % 5 == 2, F.lit('"changed"')).otherwise(
            F.concat(F.lit("W/"), F.col("tag"))), F.lit("last-modified"), F.col("day"), F.lit("date"),
            again.cast("string"), F.lit("content-type"), F.lit("text/plain")).alias("headers"),
        F.lit(None).cast("string").alias("digest"))
    return response.unionByName(revisit)

"""Resolution of not-modified revisits to the response they stand for.

An as-of join by canonical URL: a revisit record takes the latest earlier full
response of its URL, provided its validator agrees (entity tag, compared
weakly; else Last-Modified; else payload digest; else unchecked), and the stored
headers are refreshed with the revisit's headers that a 304 may update.

The join is a running window over responses and revisits of a URL in time order.
Time is cut at approximate quantiles of all records, the window runs inside
(URL, time range), and what enters a range from earlier ranges is carried over
from one row a (URL, range). A URL with a third of all records is spread over
the ranges. Bodies never enter the window; only their record ids do.

Defined results: null or empty URLs match nothing (outcome ``no_response``); a
null time makes a record no part of any order (same outcome; as a response it is
ignored). At equal times responses come before revisits, and of several
responses the largest record_id counts as the latest. Repeated revisit rows are
resolved each. Extra columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TIME_RANGES = 64

# Query parameters that only track visits, and headers of a 304
# that must not replace stored ones (framing and representation fields).
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "ref")
NOT_UPDATED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
               "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Host (lower case, without ``www.`` and default port) and path (without
    trailing slash and ``.html``), then the sorted parameters that aren't for
    tracking; scheme and fragment go."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^(?i)https?://", "")
    place = F.regexp_extract(bare, r"^[^?]*", 0)
    host = F.lower(F.regexp_extract(place, r"^[^/]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(place, r"/.*$", 0), r"\.html$", ""), "/+$", "")
    params = F.array_sort(F.filter(
        F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"),
        lambda p: (p != "") & ~F.regexp_extract(p, "^[^=]*", 0).isin(*TRACKING)))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.concat_ws("&", params)))
                    .otherwise(F.lit("")))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(spark: SparkSession, records: DataFrame, time_ranges: int = TIME_RANGES) -> DataFrame:
    """``records``: record_id, kind ('response' or 'revisit'), url, ts, status,
    digest, headers map (lower-case names). Per revisit: record_id,
    canonical_url, source_id, outcome, status, headers."""
    rec = records.select(
        F.col("record_id").cast("long").alias("record_id"), F.lower("kind").alias("kind"),
        F.nullif(canonical_url(F.col("url")), F.lit("")).alias("canonical_url"), F.col("ts").cast("long").alias("ts"),
        F.col("status").cast("int").alias("status"), F.col("digest").cast("string").alias("digest"), "headers")
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    rec = rec.where(full | (F.col("kind") == "revisit"))
    cuts = sorted(set(records.agg(F.percentile_approx(
        F.col("ts").cast("long"), [k / time_ranges for k in range(1, time_ranges)], 10 * time_ranges)).first()[0] or []))
    span = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]).cast("array<bigint>"),
                           lambda c: c <= F.col("ts")))
    ok = F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()
    slim = (rec.where(ok).withColumn("span", span)
            .withColumn("later", (F.col("kind") == "revisit").cast("int"))
            .withColumn("src", F.when(F.col("kind") == "response", F.struct(
                "ts", "record_id", "status", "digest", F.map_entries("headers").alias("headers")))))
    last = slim.where("src IS NOT NULL").groupBy("canonical_url", "span").agg(F.max_by("src", F.struct("ts", "record_id")).alias("src"))
    spans = slim.groupBy("canonical_url", "span").agg(F.lit(1).alias("one")).join(last, ["canonical_url", "span"], "left")
    over = Window.partitionBy("canonical_url").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carry = spans.select("canonical_url", "span", F.last("src", ignorenulls=True).over(over).alias("carry"))
    run = (Window.partitionBy("canonical_url", "span").orderBy("ts", "later", "record_id")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (slim.withColumn("here", F.last("src", ignorenulls=True).over(run)).where("kind = 'revisit'")
             .join(carry, ["canonical_url", "span"])
             .withColumn("src", F.coalesce("here", "carry")).select("record_id", "canonical_url", "digest", "headers", "src"))
    none = F.lit(None).cast(found.schema["src"].dataType)
    found = found.unionByName(rec.where((F.col("kind") == "revisit") & ~ok)
                              .select("record_id", "canonical_url", "digest", "headers", none.alias("src")))
    old = F.map_from_entries(F.coalesce(F.col("src.headers"), F.array().cast(
        "array<struct<key:string,value:string>>")))
    new = F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>"))

    def agree(name: str, clean=lambda c: c) -> Column:
        return clean(new[name]) == clean(old[name])

    both = lambda name: new[name].isNotNull() & old[name].isNotNull()
    valid = (F.when(both("etag"), agree("etag", _weak)).when(both("last-modified"), agree("last-modified"))
             .when(F.col("digest").isNotNull() & F.col("src.digest").isNotNull(), F.col("digest") == F.col("src.digest"))
             .otherwise(F.lit(True)))
    outcome = (F.when(F.col("src").isNull(), "no_response").when(~valid, "validator_mismatch").otherwise("resolved"))
    fresh = F.map_filter(new, lambda k, v: ~k.isin(*NOT_UPDATED))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    done = F.col("outcome") == "resolved"
    return (found.withColumn("outcome", outcome)
            .select("record_id", "canonical_url", F.when(done, F.col("src.record_id")).alias("source_id"), "outcome",
                    F.when(done, F.col("src.status")).alias("status"), F.when(done, merged).alias("headers")))


def crawl_records(pages: DataFrame) -> DataFrame:
    """Crawl records that a table of pages stands for: each page is a full
    response at time page_id, and a conditional request ``LAG`` later (made with
    the page's own entity tag) is answered 304 as a revisit record."""
    lag = 1000
    digest = F.md5(F.coalesce("html", F.lit("")))
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("string")
    pages = pages.withColumn("digest_", digest).withColumn("size_", size)
    day = lambda t: (t.cast("string"))
    response = pages.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url",
        F.col("page_id").alias("ts"), F.lit(200).alias("status"), F.col("digest_").alias("digest"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.col("size_"),
                     F.lit("etag"), F.col("digest_"), F.lit("date"), day(F.col("page_id"))).alias("headers"))
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url",
        (F.col("page_id") + lag).alias("ts"), F.lit(304).alias("status"), F.lit(None).cast("string").alias("digest"),
        F.create_map(F.lit("content-length"), F.lit("0"), F.lit("etag"), F.concat(F.lit("W/"), F.col("digest_")),
                     F.lit("date"), day(F.col("page_id") + lag), F.lit("cache-control"), F.lit("max-age=60")).alias("headers"))
    return response.unionByName(revisit)

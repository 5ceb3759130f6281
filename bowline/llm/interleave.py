"""Sharding by proportional stratified interleaving, in DataFrame operations.

Within each source the rows are shuffled by a seeded hash and ranked; a row's
fractional rank is (rank - 1 + phase) / rows of the source, the phase a seeded
fraction of the source, so that small sources don't all fall on the same place.
Sorting all rows by fractional rank interleaves the sources in proportion, and
cutting that order into equal runs gives shards whose counts differ by at most
one and whose mixtures match the corpus.

No window spans a source or the corpus: both ranks are the row's number inside a
hash (or fraction) range of about ``RANGE_ROWS`` rows plus the rows of the ranges
before, which are summed from counts. A source with a third of all rows is
spread over as many ranges as it needs.

Defined results: null text has size 1 and the checksum of no bytes; a null
source is a stratum of its own; repeated rows and null doc_ids each get a slot
(ties in the hash are ordered by doc_id, checksum and size, so only equal rows
are interchangeable). Extra columns are ignored. Fewer rows than shards: the
first shards get one each. Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bowline.llm.common import Scratch

SHARDS = 8
SEED = "interleave-1"
RANGE_ROWS = 50_000     # rows ranked in one window group, at most about
MIN_RANGES = 64         # ranges even of few rows, so that all tasks have a share
_UNIT = float(2 ** 60)


def _hash60(*parts: Column) -> Column:
    """60 bits of an MD5, as a long."""
    digest = F.md5(F.concat_ws(":", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _before(counts: DataFrame, over: list[str], by: str) -> DataFrame:
    """Adds ``before``: rows of the ranges that precede."""
    w = Window.partitionBy(*over).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long"))


def shard_rows(spark: SparkSession, docs: DataFrame, shards: int = SHARDS,
               range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    scratch = Scratch(spark, "interleave")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    total = slim.count()
    ranges = max(1, -(-total // range_rows), min(MIN_RANGES, total // 500))
    key = _hash60(F.col("doc_id"))

    def keyed(df: DataFrame) -> DataFrame:
        return (df.withColumn("key", key)
                .withColumn("range", F.floor(F.col("key") / F.lit(_UNIT) * ranges).cast("long"))
                .withColumn("stratum", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))))

    counts = scratch.write(keyed(slim).groupBy("stratum", "range").agg(F.count(F.lit(1)).alias("n")), "counts")
    strata = (_before(counts, ["stratum"], "range")
              .join(counts.groupBy("stratum").agg(F.sum("n").alias("rows")), "stratum")
              .drop("n").withColumn("phase", _hash60(F.col("stratum")) / F.lit(_UNIT)))
    text = F.col("text").cast("string")
    rows = keyed(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32")))
    order = ["key", "doc_id", "text_crc32", "size"]
    in_range = F.row_number().over(Window.partitionBy("stratum", "range").orderBy(*order))
    ranked = (rows.withColumn("k", in_range).join(strata, ["stratum", "range"])
              .withColumn("frac", (F.col("before") + F.col("k") - 1 + F.col("phase")) / F.col("rows"))
              .withColumn("cut", F.least(F.floor(F.col("frac") * ranges), F.lit(ranges - 1)).cast("long"))
              .select("doc_id", "size", "text_crc32", "key", "stratum", "frac", "cut"))
    ranked = scratch.write(ranked, "ranked")
    cuts = _before(ranked.groupBy("cut").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0)), ["all"], "cut")
    in_cut = F.row_number().over(Window.partitionBy("cut").orderBy("frac", "stratum", *order))
    each, more = divmod(total, shards)
    at = F.col("before") + F.col("k") - 1
    edge = more * (each + 1)      # positions in the shards that hold one row more
    return (ranked.withColumn("k", in_cut).join(cuts.select("cut", "before"), "cut").withColumn("at", at)
            .withColumn("shard", F.when(F.col("at") < edge, F.floor(F.col("at") / F.lit(each + 1)))
                        .otherwise(more + F.floor((F.col("at") - edge) / F.lit(max(each, 1)))).cast("int"))
            .withColumn("slot", F.col("at") - F.col("shard") * each - F.least("shard", F.lit(more)))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))

"""Importance resampling towards a target distribution, drawn by a parallel sort.

Weights: every word run is hashed into one of ``buckets`` buckets. Bucket counts
of the corpus and of the target give an array of gains (log ratios, smoothed by
one); a document's weight is the sum of the gains of its features, and its score
adds a Gumbel noise fixed by its id, so that the highest scores are a draw
without replacement in proportion to the importance weights.

The draw is a parallel sort by regular sampling:

1. Each task sorts its rows (a run) and the runs are written with a row number
   that makes every key distinct, so ties and repeated rows split like others.
2. Every w-th row of every run is a regular sample. At regular places of the
   sorted samples stand the splitters, which bounds a segment by about
   ``segment_rows`` rows whatever the scores are. More samples than the driver
   should hold are sampled again in the same way.
3. Runs are cut at the splitters; prefix counts of the segments tell the first
   rank of each. Only segments that reach the drawn ranks are exchanged, and each
   merges its runs and numbers its rows.

Defined results: null or wordless text has no features and weight 0. A null
doc_id is hashed as the empty string and stands behind equal scores. Repeated
rows are drawn as rows of their own. Extra columns are ignored. Empty documents:
empty result; empty target: gains against no counts. Documents with fewer than
``min_words`` words are scored but never drawn.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bowline.llm.common import Scratch, arrow_map

NGRAM = 1                # features: runs of 1..NGRAM words
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10             # share of the long enough documents that is drawn
SEED = 2024
SEGMENT_ROWS = 500_000   # rows of a segment, about
SAMPLES = 100_000        # samples the driver sorts, at most

# ASCII other than letters and digits separates words; A-Z become lower case.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                    for c in range(256))
_LAST = 2**63 - 1        # sort place of a null doc_id


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


def feature_buckets(words: list[bytes], ngram: int, buckets: int) -> np.ndarray:
    """Bucket of every run of 1..ngram words, repeats included."""
    runs = [b" ".join(words[i:i + n]) for n in range(2, ngram + 1) for i in range(len(words) - n + 1)]
    return np.fromiter(map(zlib.crc32, words + runs), np.int64, len(words) + len(runs)) % buckets


def _count_fn(ngram: int, buckets: int):
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def fn(cols):
        n = np.zeros(buckets, np.int64)
        for t in cols["text"]:
            n += np.bincount(feature_buckets(words_of(t), ngram, buckets), minlength=buckets)
        at = np.flatnonzero(n)
        return {"bucket": at, "n": n[at]}

    return arrow_map(fn, schema)


def bucket_counts(texts: DataFrame, ngram: int, buckets: int) -> np.ndarray:
    """Features in each bucket; one row for each bucket comes to the driver."""
    rows = (texts.select(F.col("text").cast("string").alias("text"))
            .mapInArrow(_count_fn(ngram, buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    size, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score_fn(gain: np.ndarray, ngram: int, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("n_words", pa.int64()),
                        ("weight", pa.int64()), ("score", pa.int64())])

    def fn(cols):
        words = [words_of(t) for t in cols["text"]]
        hit = [feature_buckets(w, ngram, len(gain)) for w in words]
        weight = [int(gain[h].sum()) for h in hit]
        return {"doc_id": cols["doc_id"], "n_features": [len(h) for h in hit], "n_words": [len(w) for w in words],
                "weight": weight, "score": [w + noise(d, seed) for w, d in zip(weight, cols["doc_id"])]}

    return arrow_map(fn, schema)


def score_documents(docs: DataFrame, target: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS,
                    seed: int = SEED) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_features, n_words, weight, score."""
    gain = gains(bucket_counts(docs, ngram, buckets), bucket_counts(target, ngram, buckets))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_score_fn(gain, ngram, seed),
                           "doc_id long, n_features long, n_words long, weight long, score long")


# The order of the draw, ascending; run_row makes every key distinct.
_KEY = ["down", "place", "run_row"]
_ROW_BITS = 33           # monotonically_increasing_id numbers a task's rows in these bits


def segment_size(rows: int, segment_rows: int) -> int:
    """Rows of a segment: about ``segment_rows``, but at least 64 segments, so
    that all tasks have a share, and at most 2000 of them."""
    return max(1, -(-rows // 2000), min(segment_rows, -(-rows // 64)))


def regular_splitters(runs: DataFrame, rows: int, segment: int, samples: int, scratch: Scratch) -> np.ndarray:
    """Keys (ascending, one a row) that cut the sorted ``runs`` into segments of
    about ``segment`` rows. A sample stands for ``weight`` rows of its run, so a
    cut is off by at most ``weight`` rows in each run."""
    at = F.col("run_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    table, weight = runs.select(*_KEY, at.alias("at")), 1
    n_runs = max(1, runs.agg(F.countDistinct(F.shiftright("run_row", _ROW_BITS))).first()[0])
    while True:
        step = max(1 if rows <= samples * weight else 2, segment // (2 * n_runs * weight))
        kept = table.where(F.pmod("at", F.lit(step)) == step // 2).select(*_KEY)
        weight *= step
        if rows <= samples * weight:
            break
        # still many: the samples are sorted in runs and sampled again
        n_runs = -(-rows // (samples * weight))
        again = kept.repartition(n_runs).sortWithinPartitions(*_KEY)
        again = scratch.write(again.withColumn("at", F.monotonically_increasing_id()), "samples")
        table = again.withColumn("at", F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    got = np.array([tuple(r) for r in kept.collect()], np.int64).reshape(-1, 3)
    got = got[np.lexsort(got.T[::-1])]
    every = max(1, segment // weight)
    return got[every - 1::every]


def _cut_fn(splitters: np.ndarray, schema: pa.Schema):
    """Adds the segment of each row: how many splitters stand before it."""

    def run(batches):
        for batch in batches:
            keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in _KEY], axis=1)
            both = np.concatenate([keys, splitters])
            is_splitter = np.arange(len(both)) >= len(keys)
            order = np.lexsort((is_splitter, both[:, 2], both[:, 1], both[:, 0]))
            segment = np.empty(len(both), np.int64)
            segment[order] = np.cumsum(is_splitter[order])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment[:len(keys)])], schema=schema)

    return run


def rank_highest(spark: SparkSession, rows: DataFrame, score: str, tie: str, draw: int | None = None,
                 percent: int = PERCENT, segment_rows: int = SEGMENT_ROWS, samples: int = SAMPLES) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, .. for the ``draw`` highest scores (else
    ``percent`` of the rows, rounded down), ties to the smaller ``tie``; null
    for the others. All columns must be longs."""
    scratch = Scratch(spark, "psrs")
    keyed = rows.withColumn("down", -F.col(score)).withColumn("place", F.coalesce(tie, F.lit(_LAST)))
    runs = scratch.write(keyed.sortWithinPartitions("down", "place")
                         .withColumn("run_row", F.monotonically_increasing_id()), "runs")
    total = runs.count()
    draw = percent * total // 100 if draw is None else min(draw, total)
    splitters = regular_splitters(runs, total, segment_size(total, segment_rows), samples, scratch)
    fields = [(c, pa.int64()) for c in [*runs.columns, "segment"]]
    cut = scratch.write(runs.mapInArrow(_cut_fn(splitters, pa.schema(fields)),
                                        ", ".join(f"{c} long" for c, _ in fields)), "cut")
    # one row for each segment, at most about 2000 and some
    before, reached = [], 0
    for seg, n in sorted(map(tuple, cut.groupBy("segment").count().collect())):
        if reached < draw:
            before.append((seg, reached))
        reached += n
    first = spark.createDataFrame(before, "segment long, before long")
    drawn = cut.join(F.broadcast(first), "segment", "left")
    place = F.col("before") + F.row_number().over(Window.partitionBy("segment").orderBy(*_KEY))
    ranked = (drawn.where("before IS NOT NULL").withColumn("rank", place)
              .withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank"))))
    rest = drawn.where("before IS NULL").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(*rows.columns, "rank")


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
             segment_rows: int = SEGMENT_ROWS, samples: int = SAMPLES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank."""
    scored = Scratch(spark, "resample").write(score_documents(docs, target, ngram, buckets, seed), "scored")
    long_enough = scored.where(F.col("n_words") >= min_words).drop("n_words")
    short = scored.where(F.col("n_words") < min_words).drop("n_words")
    ranked = rank_highest(spark, long_enough, "score", "doc_id", None, percent, segment_rows, samples)
    return ranked.unionByName(short.withColumn("rank", F.lit(None).cast("long")))

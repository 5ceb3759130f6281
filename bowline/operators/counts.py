"""Per-class and corpus-wide counts over token rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.sources.corpus import ClassSet, Corpus


def class_cols(prefix: str, k: int) -> list[str]:
    return [f"{prefix}_{j}" for j in range(1, k + 1)]


def words_per_class_wide(train: Corpus, k: int, extra_vocab=()) -> DataFrame:
    """(term, c_1..c_k): training token counts per class, one row per term of
    the shared vocabulary (training terms plus the terms of ``extra_vocab``
    corpora, which count towards no class). One hash aggregate, partial before
    the shuffle on ``term``."""
    cells = train.cells()
    for extra in extra_vocab:
        cells = cells.unionByName(extra.cells().select(
            "doc_id", F.lit(None).cast("int").alias("class_id"), "term", F.lit(0).cast("bigint").alias("cnt")))
    return cells.groupBy("term").agg(
        *[F.sum(F.when(F.col("class_id") == F.lit(j), F.col("cnt")).otherwise(F.lit(0))).cast("bigint")
          .alias(f"c_{j}") for j in range(1, k + 1)])


def words_per_class_long(train: Corpus) -> DataFrame:
    """(class_id, term, cnt): the same counts in long form (nonzero cells)."""
    return (train.labelled().cells()
                 .groupBy("class_id", "term").agg(F.sum("cnt").alias("cnt")))


def class_totals(train: Corpus) -> DataFrame:
    """(class_id, n_docs, n_words): documents and total words per class (A2, A3)."""
    return (train.labelled().docs().groupBy("class_id")
                 .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_words")))


@dataclass
class ClassStats:
    """Per-class totals collected to the driver (k values each)."""

    n_docs: tuple[int, ...]
    n_words: tuple[int, ...]

    @property
    def total_docs(self) -> int:
        return sum(self.n_docs)

    @property
    def total_words(self) -> int:
        return sum(self.n_words)


def collect_class_stats(train: Corpus, classes: ClassSet, counts: DataFrame | None = None) -> ClassStats:
    """n_docs per class from the document rows (no text read); n_words from
    the (written) wide counts table when given."""
    k = classes.k
    if counts is None:
        rows = {r["class_id"]: r for r in class_totals(train).collect()}
        n_docs = tuple(int(rows[j]["n_docs"]) if j in rows else 0 for j in range(1, k + 1))
        n_words = tuple(int(rows[j]["n_words"] or 0) if j in rows else 0 for j in range(1, k + 1))
        return ClassStats(n_docs, n_words)
    nd = {r["class_id"]: int(r["n_docs"]) for r in docs_per_class(train).collect()}
    w = counts.agg(*[F.sum(f"c_{j}").alias(f"c_{j}") for j in range(1, k + 1)]).first()
    n_docs = tuple(nd.get(j, 0) for j in range(1, k + 1))
    n_words = tuple(int(w[f"c_{j}"] or 0) for j in range(1, k + 1))
    return ClassStats(n_docs, n_words)


def docs_per_class(train: Corpus) -> DataFrame:
    """(class_id, n_docs) from the document rows alone: no text is read (A2)."""
    return train.labelled().rows().groupBy("class_id").agg(F.count(F.lit(1)).alias("n_docs"))


def word_totals(train: Corpus) -> DataFrame:
    """(term, total): corpus count of each term (A5)."""
    return train.cells().groupBy("term").agg(F.sum("cnt").alias("total"))


def document_lengths(corpus: Corpus) -> DataFrame:
    """(doc_id, n_tokens): row sums of the count matrix (A6) - no shuffle."""
    return corpus.docs().select("doc_id", "n_tokens")


@dataclass
class OutlierBounds:
    avg: float
    sd: float

    @property
    def low(self) -> float:
        return self.avg - 2 * self.sd

    @property
    def high(self) -> float:
        return self.avg + 2 * self.sd


def frequency_outlier_bounds(counts: DataFrame, k: int, vocab_size: int,
                             stats: ClassStats) -> OutlierBounds:
    """Mean and spread of per-term totals.

    avg = total words / V. The spread sums (total - avg)^2 over all V vocabulary
    terms (terms absent from ``counts`` have total 0) plus the document-count
    column, and divides by V - the reference's definition.
    """
    avg = stats.total_words / vocab_size
    tot = sum((F.col(c) for c in class_cols("c", k)), F.lit(0))
    row = counts.agg(
        F.sum(F.pow(tot - F.lit(avg), 2)).alias("ss"),
        F.count(F.lit(1)).alias("n")).first()
    ss = float(row["ss"] or 0.0)
    ss += (vocab_size - int(row["n"])) * avg * avg
    ss += (stats.total_docs - avg) ** 2
    return OutlierBounds(avg, math.sqrt(ss / vocab_size))


def word_frequency_outliers(counts: DataFrame, k: int, bounds: OutlierBounds) -> DataFrame:
    """(term, total, kept): whether each term's total lies within avg +/- 2 sd."""
    tot = sum((F.col(c) for c in class_cols("c", k)), F.lit(0))
    return counts.select(
        "term", tot.alias("total"),
        ((tot >= F.lit(bounds.low)) & (tot <= F.lit(bounds.high))).alias("kept"))

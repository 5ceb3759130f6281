"""Naive Bayes over thousands of classes (A1, N1, N2), in blocks of classes.

One column for each of k classes stops being a plan at a few hundred. Here the
classes are cut into blocks of ``block``: a row (term, block, c_1..c_B) holds the
counts of one block, only for the blocks in which the term occurs, so no row or
plan is wider than a block, whatever k is.

A score is split into what a document's length gives and what its terms give:

    sum_t n_t log2((c + beta) / den) = sum_t n_t log2((c + beta) / beta) + n log2(beta / den)

where the first sum has terms only where c > 0. Scoring therefore joins tokens to
the blocks that know them, sums by (document, block), and adds the length part to
every block of every document; the best class of each block and then of each
document is the answer (lowest class on ties, NaN counts as largest).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bowline.functions.numeric import NEG_INF, argmax_1based
from bowline.operators.counts import docs_per_class
from bowline.operators.joins import wide_row_bytes
from bowline.session import broadcast_limit_bytes
from bowline.sources.corpus import ClassSet, Corpus
from bowline.sources.tables import written_table

BLOCK = 64      # classes of a block; well below the limit of whole-stage codegen


def _cols(prefix: str, block: int) -> list[str]:
    return [f"{prefix}_{j}" for j in range(1, block + 1)]


def words_per_class_blocks(train: Corpus, block: int = BLOCK, extra_vocab=()) -> DataFrame:
    """(term, block, c_1..c_B): token counts of classes block * B + 1 ..; rows
    with a null block hold the terms that only unlabelled documents have."""
    cells = train.cells()
    for extra in extra_vocab:
        cells = cells.unionByName(extra.cells().select(
            "doc_id", F.lit(None).cast("int").alias("class_id"), "term", F.lit(0).cast("bigint").alias("cnt")))
    at = F.col("class_id") - 1
    cells = cells.select("term", "cnt", F.floor(at / F.lit(block)).cast("int").alias("block"),
                         F.pmod(at, F.lit(block)).alias("at"))
    return cells.groupBy("term", "block").agg(
        *[F.sum(F.when(F.col("at") == j, F.col("cnt")).otherwise(0)).cast("bigint").alias(f"c_{j + 1}")
          for j in range(block)])


@dataclass
class BlockedNaiveBayes:
    classes: ClassSet
    block: int
    counts: DataFrame          # (term, block, c_1..c_B), a written table
    n_rows: int
    key_bytes: float
    n_docs: dict[int, int]     # by class, classes without documents left out
    n_words: dict[int, int]
    vocab_size: int
    beta: float

    @property
    def n_blocks(self) -> int:
        return -(-self.classes.k // self.block)

    def log_prior(self, c: int) -> float:
        n = self.n_docs.get(c, 0)
        return math.log2(n / sum(self.n_docs.values())) if n else NEG_INF

    def denominator(self, c: int) -> float:
        return self.n_words.get(c, 0) + self.beta * self.vocab_size

    def class_table(self) -> DataFrame:
        """(class_id, log_prior, log_unseen): k rows, what a class scores without
        terms and for a term it never saw."""
        rows = [(c, self.log_prior(c), math.log2(self.beta / self.denominator(c)))
                for c in range(1, self.classes.k + 1)]
        return self.counts.sparkSession.createDataFrame(rows, "class_id int, log_prior double, log_unseen double")

    def _block_table(self) -> DataFrame:
        """(block, p_1..p_B, u_1..u_B): the class table, a row for each block;
        places past the last class never win."""
        rows = []
        for b in range(self.n_blocks):
            ids = [b * self.block + j for j in range(1, self.block + 1)]
            known = [c <= self.classes.k for c in ids]
            rows.append((b, *[self.log_prior(c) if k else NEG_INF for c, k in zip(ids, known)],
                         *[math.log2(self.beta / self.denominator(c)) if k else 0.0 for c, k in zip(ids, known)]))
        names = ["block", *_cols("p", self.block), *_cols("u", self.block)]
        return self.counts.sparkSession.createDataFrame(rows, ", ".join(
            f"{n} {'int' if n == 'block' else 'double'}" for n in names))

    def log_likelihood_long(self) -> DataFrame:
        """(class_id, term, log_likelihood) of the nonzero counts; every other
        term of the vocabulary has the class's ``log_unseen``."""
        cells = F.array(*[F.struct((F.col("block") * self.block + j).cast("int").alias("class_id"),
                                   F.col(f"c_{j}").alias("c")) for j in range(1, self.block + 1)])
        den = F.log2(F.lit(self.beta)) - F.col("log_unseen")
        return (self.counts.where("block IS NOT NULL").select("term", F.inline(cells)).where("c > 0")
                .join(F.broadcast(self.class_table()), "class_id")
                .select("class_id", "term", (F.log2(F.col("c") + F.lit(self.beta)) - den).alias("log_likelihood")))


def fit_class_blocks(train: Corpus, classes: ClassSet, block: int = BLOCK, extra_vocab=(),
                     vocab_size: int | None = None, beta: float | None = None) -> BlockedNaiveBayes:
    """Fit on the labelled rows of ``train``; the vocabulary is every term of
    ``train`` and ``extra_vocab``; ``beta`` defaults to 1 / its size."""
    counts = written_table(words_per_class_blocks(train, block, extra_vocab), "class-blocks")
    size = counts.agg(F.count(F.lit(1)).alias("n"), F.avg(F.octet_length(F.col("term").cast("string"))).alias("b")).first()
    v = vocab_size if vocab_size is not None else counts.select("term").distinct().count()
    words = {}
    for r in counts.where("block IS NOT NULL").groupBy("block").agg(
            *[F.sum(c).alias(c) for c in _cols("c", block)]).collect():
        words |= {r["block"] * block + j: int(r[f"c_{j}"]) for j in range(1, block + 1)}
    docs = {r["class_id"]: int(r["n_docs"]) for r in docs_per_class(train).collect()}
    return BlockedNaiveBayes(classes, block, counts, int(size["n"]), size["b"] or 0.0, docs, words, v,
                             beta if beta is not None else 1.0 / max(1, v))


def scores_class_blocks(model: BlockedNaiveBayes, test: Corpus) -> DataFrame:
    """(doc_id, class_id, block, s_1..s_B) for every document and block."""
    spark, size = model.counts.sparkSession, model.block
    gains = model.counts.where("block IS NOT NULL").select(
        "term", "block", *[F.log2((F.col(f"c_{j}") + F.lit(model.beta)) / F.lit(model.beta)).alias(f"g_{j}")
                           for j in range(1, size + 1)])
    if model.n_rows * wide_row_bytes(size, model.key_bytes) <= broadcast_limit_bytes(spark):
        met = test.cells().join(F.broadcast(gains), "term")
    else:
        met = test.tf().join(gains.hint("merge"), "term")
    from_terms = met.select(
        "doc_id", "block", *[(F.col("cnt") * F.col(f"g_{j}")).alias(f"g_{j}") for j in range(1, size + 1)],
        F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("int").alias("class_id"))
    # every block of a document gets its length, so that no class is left out
    lengths = test.docs().select(
        "doc_id", F.explode(F.sequence(F.lit(0), F.lit(model.n_blocks - 1))).alias("block"),
        *[F.lit(0.0).alias(f"g_{j}") for j in range(1, size + 1)], F.col("n_tokens").alias("n"), "class_id")
    sums = from_terms.unionByName(lengths).groupBy("doc_id", "block").agg(
        *[F.sum(f"g_{j}").alias(f"g_{j}") for j in range(1, size + 1)],
        F.max("n").alias("n"), F.max("class_id").alias("class_id"))
    return sums.join(F.broadcast(model._block_table()), "block").select(
        "doc_id", "class_id", "block",
        *[(F.col(f"g_{j}") + F.col("n") * F.col(f"u_{j}") + F.col(f"p_{j}")).alias(f"s_{j}")
          for j in range(1, size + 1)])


def _best(model: BlockedNaiveBayes) -> Column:
    """(score, minus class id) of the best class of a block."""
    scores = [F.col(f"s_{j}") for j in range(1, model.block + 1)]
    return F.struct(F.array_max(F.array(*scores)).alias("score"),
                    (-(F.col("block") * model.block + argmax_1based(scores))).alias("minus_class"))


def predict_class_blocks(model: BlockedNaiveBayes, test: Corpus) -> DataFrame:
    """(doc_id, class_id, predicted)."""
    best = scores_class_blocks(model, test).select("doc_id", "class_id", _best(model).alias("best"))
    return (best.groupBy("doc_id").agg(F.max("class_id").alias("class_id"), F.max("best").alias("best"))
            .select("doc_id", "class_id", (-F.col("best.minus_class")).cast("int").alias("predicted")))

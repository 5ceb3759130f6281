"""Multinomial Naive Bayes with log2 likelihoods.

likelihood  l[y,t] = log2((c[y,t] + beta) / (W_y + beta * V))
prior       p[y]   = log2(n_y / N)          (-inf for a class without documents)
score       s[y,d] = sum over tokens t of d of l[y,t] + p[y]
class       argmax_y s[y,d] (lowest class on ties, NaN counts as largest)

The model is sparse: only terms seen in training have a row in ``counts``; a
term of the shared vocabulary that training never saw has c = 0 in every class,
so its likelihood is the per-class constant log2(beta / (W_y + beta V)).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.functions.numeric import NEG_INF, argmax_1based
from bowline.operators.counts import (
    ClassStats, class_cols, collect_class_stats, words_per_class_wide,
)
from bowline.operators.joins import wide_row_bytes
from bowline.session import broadcast_limit_bytes
from bowline.sources.corpus import ClassSet, Corpus
from bowline.sources.tables import written_table



def log_grid(start: float, stop: float, num: int) -> tuple[float, ...]:
    """``num`` values from 10**start to 10**stop, evenly spaced in the exponent."""
    step = (stop - start) / (num - 1) if num > 1 else 0.0
    return tuple(10.0 ** (start + i * step) for i in range(num))


# The smoothing grid of the beta sweep, 1e-5 .. 1 in six steps.
BETA_GRID = log_grid(-5, 0, 6)


# Sums of one row of the sweep: as many as whole-stage codegen takes.
SWEEP_COLUMNS = 80


@dataclass
class NaiveBayesModel:
    classes: ClassSet
    counts: DataFrame          # (term, c_1..c_k), a written table
    n_terms: int               # rows of ``counts``
    stats: ClassStats
    vocab_size: int            # V
    beta: float
    key_bytes: float = 24.0    # mean bytes of a term, for size checks

    @property
    def k(self) -> int:
        return self.classes.k

    def with_beta(self, beta: float) -> "NaiveBayesModel":
        return replace(self, beta=beta)

    def log_prior(self) -> list[float]:
        n = self.stats.total_docs
        return [math.log2(c / n) if c > 0 else NEG_INF for c in self.stats.n_docs]

    def _denominators(self, beta: float) -> list[float]:
        return [w + beta * self.vocab_size for w in self.stats.n_words]

    def unseen_log_likelihood(self, beta: float | None = None) -> list[float]:
        b = self.beta if beta is None else beta
        return [math.log2(b / d) for d in self._denominators(b)]

    def log_likelihood(self, with_seen: bool = False) -> DataFrame:
        """(term, l_1..l_k[, seen]) for every vocabulary term of the model;
        ``seen`` = the term occurs in a labelled training document."""
        dens = self._denominators(self.beta)
        extra = []
        if with_seen:
            extra = [(sum((F.col(f"c_{j}") for j in range(1, self.k + 1)), F.lit(0)) > 0).alias("seen")]
        return self.counts.select(
            "term",
            *[F.log2((F.col(f"c_{j}") + F.lit(self.beta)) / F.lit(dens[j - 1])).alias(f"l_{j}")
              for j in range(1, self.k + 1)], *extra)

    def log_likelihood_long(self, vocab: DataFrame | None = None) -> DataFrame:
        """(class_id, term, log_likelihood, log_prior): the dense k x V table.

        ``vocab`` (term) adds the vocabulary terms that training never saw.
        """
        lik = self.log_likelihood()
        if vocab is not None:
            unseen = self.unseen_log_likelihood()
            lik = vocab.join(lik, "term", "left").select(
                "term", *[F.coalesce(F.col(f"l_{j}"), F.lit(unseen[j - 1])).alias(f"l_{j}")
                          for j in range(1, self.k + 1)])
        prior = self.log_prior()
        cells = F.array(*[F.struct(F.lit(j).alias("class_id"), F.col(f"l_{j}").alias("log_likelihood"),
                                   F.lit(prior[j - 1]).alias("log_prior"))
                          for j in range(1, self.k + 1)])
        return lik.select("term", F.inline(cells)).select(
            "class_id", "term", "log_likelihood", "log_prior")


def nb_fit(train: Corpus, classes: ClassSet, extra_vocab=(), vocab_size: int | None = None,
           beta: float | None = None) -> NaiveBayesModel:
    """Fit on the labelled rows of ``train``.

    The shared vocabulary is every term of ``train`` and of the ``extra_vocab``
    corpora (e.g. the documents to classify); it is built in the same single
    counting pass, and V = its size unless ``vocab_size`` is given.
    ``beta`` defaults to 1 / V.
    """
    counts = written_table(words_per_class_wide(train, classes.k, extra_vocab), "class-counts")
    size = counts.agg(F.count(F.lit(1)).alias("n"),
                      F.avg(F.octet_length(F.col("term").cast("string"))).alias("bytes")).first()
    n_terms = int(size["n"])
    stats = collect_class_stats(train, classes, counts)
    v = vocab_size if vocab_size is not None else n_terms
    b = beta if beta is not None else 1.0 / v
    if b <= 0:
        raise ValueError("beta must be > 0")
    return NaiveBayesModel(classes, counts, n_terms, stats, v, b, size["bytes"] or 0.0)


def _meet(test: Corpus, side: DataFrame, n_terms: int, row_bytes: float) -> DataFrame:
    """Cells of ``test`` left-joined to the per-term table ``side``, and one row
    with a null term for documents without cells. While ``side`` fits a
    broadcast, token rows meet it in place; beyond that, only (document, term)
    counts are shuffled, and the null terms stay out of the join."""
    if n_terms * row_bytes <= broadcast_limit_bytes(side.sparkSession):
        return test.scoring_cells().join(F.broadcast(side), "term", "left")
    empty = test.rows().select("doc_id", "class_id", F.lit(0).cast("bigint").alias("cnt"))
    return test.tf().join(side.hint("merge"), "term", "left").unionByName(empty, allowMissingColumns=True)


def nb_scores(model: NaiveBayesModel, test: Corpus, vocab: str = "shared") -> DataFrame:
    """(doc_id, class_id, s_1..s_k) for every document of ``test``.

    ``vocab='shared'``: a test term outside the training terms scores the
    smoothed unseen value; ``vocab='train'``: such terms are ignored.
    Plan: cells -> left join to the likelihood table (broadcast when its checked
    size allows) -> hash aggregate by document (partial before the shuffle, so
    one row per document moves).
    """
    if vocab not in ("shared", "train"):
        raise ValueError("vocab must be 'shared' or 'train'")
    k = model.k
    lik = model.log_likelihood(with_seen=(vocab == "train"))
    unseen = model.unseen_log_likelihood()
    joined = _meet(test, lik, model.n_terms, wide_row_bytes(k, model.key_bytes))
    prior = model.log_prior()
    aggs = []
    for j in range(1, k + 1):
        if vocab == "shared":
            value = F.coalesce(F.col(f"l_{j}"), F.lit(unseen[j - 1]))
        else:  # terms without training occurrences are ignored
            value = F.when(F.col("seen"), F.col(f"l_{j}")).otherwise(F.lit(0.0))
        contrib = F.when(F.col("term").isNull(), F.lit(0.0)).otherwise(F.col("cnt") * value)
        aggs.append(F.sum(contrib).alias(f"a_{j}"))
    per_doc = joined.groupBy("doc_id", "class_id").agg(*aggs)
    return per_doc.select(
        "doc_id", "class_id",
        *[(F.col(f"a_{j}") + F.lit(prior[j - 1])).alias(f"s_{j}") for j in range(1, k + 1)])


def nb_predict(model: NaiveBayesModel, test: Corpus, vocab: str = "shared") -> DataFrame:
    """(doc_id, class_id, predicted)."""
    scores = nb_scores(model, test, vocab)
    return scores.select("doc_id", "class_id",
                         argmax_1based([F.col(c) for c in class_cols("s", model.k)]).alias("predicted"))


def scores_long(scores: DataFrame, k: int) -> DataFrame:
    """(doc_id, class_id, score) for all k classes of each document."""
    cells = F.array(*[F.struct(F.lit(j).alias("score_class"), F.col(f"s_{j}").alias("score"))
                      for j in range(1, k + 1)])
    return scores.select("doc_id", F.inline(cells))


def nb_beta_sweep(model: NaiveBayesModel, test: Corpus, betas=BETA_GRID,
                  vocab: str = "shared") -> DataFrame:
    """(beta, doc_id, class_id, predicted) for every beta, from one counts table.

    The log likelihoods of all smoothing values are computed once per term, on
    the model side, in groups of smoothing values that are ``SWEEP_COLUMNS`` wide
    at most; a token row meets them in one (size-checked) join and is repeated
    for each group, not for each value (once with few classes, so not at all), and
    no logarithm is taken per token. The priors do not depend on beta. One
    aggregate by (group, document).
    """
    if vocab not in ("shared", "train"):
        raise ValueError("vocab must be 'shared' or 'train'")
    k = model.k
    words = model.stats.n_words
    betas = [float(b) for b in betas]
    width = max(1, min(len(betas), SWEEP_COLUMNS // k))
    groups = [betas[lo:lo + width] for lo in range(0, len(betas), width)]
    names = [f"l_{i}_{j}" for i in range(width) for j in range(1, k + 1)]
    seen = sum((F.col(f"c_{j}") for j in range(1, k + 1)), F.lit(0)) > 0

    def smoothed(count, beta: float):
        return [F.log2((count(j) + F.lit(beta)) / F.lit(words[j - 1] + beta * model.vocab_size))
                for j in range(1, k + 1)]

    def grid(values):
        """(group, l_i_j ..) for every group; a place without a beta counts 0."""
        rows = []
        for g, some in enumerate(groups):
            cells = [v for b in some for v in values(b)] + [F.lit(0.0)] * (k * (width - len(some)))
            rows.append(F.struct(F.lit(g).alias("group"), *[v.alias(n) for v, n in zip(cells, names)]))
        return F.array(*rows)

    nothing = grid(lambda b: [F.lit(0.0)] * k)
    known = grid(lambda b: smoothed(lambda j: F.col(f"c_{j}"), b))
    unseen = grid(lambda b: [F.lit(v) for v in model.unseen_log_likelihood(b)])
    if vocab == "train":  # terms without training occurrences are ignored
        known, unseen = F.when(seen, known).otherwise(nothing), nothing
    lik = model.counts.select("term", known.alias("grid"))
    joined = _meet(test, lik, model.n_terms, wide_row_bytes((k + 1) * len(betas), model.key_bytes))
    rows = F.when(F.col("term").isNull(), nothing).otherwise(F.coalesce(F.col("grid"), unseen))
    if len(groups) == 1:
        cells = joined.select("doc_id", "class_id", "cnt", rows[0].alias("only")).select("doc_id", "class_id", "cnt", "only.*")
    else:
        cells = joined.select("doc_id", "class_id", "cnt", F.inline(rows))
    per = cells.groupBy("group", "doc_id", "class_id").agg(*[F.sum(F.col("cnt") * F.col(n)).alias(n) for n in names])
    prior = model.log_prior()
    of_group = F.array(*[F.array(*[F.lit(b) for b in some]) for some in groups])
    best = F.array(*[argmax_1based([F.col(f"l_{i}_{j}") + F.lit(prior[j - 1]) for j in range(1, k + 1)])
                     for i in range(width)])
    return (per.select("doc_id", "class_id", F.inline(F.arrays_zip(F.get(of_group, "group").alias("beta"),
                                                                   best.alias("predicted"))))
            .where("beta IS NOT NULL").select("beta", "doc_id", "class_id", "predicted"))

"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting: round after round, each feature in turn gets a shallow tree
(at most ``LEAVES`` leaves over the feature's quantile bins) fitted to the
current gradients, added at a small rate into the feature's lookup table. Then
pairs of features are ranked by what a four-cell cut on them gains on the
remaining gradients, and the best are boosted the same way into two-dimensional
tables. A score is the logistic of the intercept plus one table entry a feature
and pair, looked up for whole batches.

The features are counts and ratios over the whole text (no id, source or
language). The model is fitted in numpy on at most ``TRAIN_ROWS`` labelled rows
(smallest hash of doc_id), a bounded sample and documented parameter; scoring
covers every row.

Defined results: null text is scored as the empty text. With no labelled row, or
labels of one class only, every score is the label mean (0.5 without any).
Repeated rows and extra columns change nothing; null doc_ids are never learned
from, but scored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.llm.common import arrow_map, at_work, free_name, hash_share

TRAIN_ROWS = 20_000
BINS = 32
LEAVES = 4
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 8
RATE = 0.1
THRESHOLD = 0.3

FEATURES = ("log_words", "mean_word", "distinct_words", "upper", "punctuation", "digits", "top_mark",
            "repeats", "top_word", "distinct_lines", "short_words", "sentence", "line_words",
            "non_ascii", "capitalised", "double_marks")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = _UPPER.copy()
_ALPHA[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_MARK &= ~(_ALPHA | _DIGIT)


def features(text: str | None) -> list[float]:
    """One value for each of FEATURES, over the whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    arr = np.frombuffer(raw, np.uint8)
    c = np.bincount(arr, minlength=256)
    words = text.split()
    n, size = max(1, len(words)), len(raw)
    marks, alpha = c[_MARK], max(1, int(c[_ALPHA].sum()))
    counts = Counter(words)
    lines = text.split("\n")
    mark = _MARK[arr]
    return [float(np.log1p(len(words))), size / n, len(counts) / n, c[_UPPER].sum() / alpha, marks.sum() / size,
            c[_DIGIT].sum() / size, marks.max() / n, sum(map(str.__eq__, words, words[1:])) / n,
            max(counts.values(), default=0) / n, len(set(lines)) / len(lines),
            sum(v for w, v in counts.items() if len(w) <= 3) / n, (c[46] + c[33] + c[63]) / n, n / len(lines),
            c[128:].sum() / size, sum(v for w, v in counts.items() if w[:1].isupper()) / n,
            int(np.count_nonzero(mark[1:] & mark[:-1])) / n]


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf value of each bin of a greedy tree on per-bin gradient sums."""
    cuts = [0, len(g)]
    G, H = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))

    def gain(lo, hi):
        at = np.arange(lo + 1, hi)
        if not len(at):
            return 0.0, lo
        l, r = H[at] - H[lo], H[hi] - H[at]
        v = ((G[at] - G[lo]) ** 2 / (l + 1) + (G[hi] - G[at]) ** 2 / (r + 1)
             - (G[hi] - G[lo]) ** 2 / (H[hi] - H[lo] + 1))
        v[(l < 1) | (r < 1)] = 0.0
        k = int(v.argmax())
        return float(v[k]), int(at[k])

    while len(cuts) <= leaves:
        best = max((gain(lo, hi) for lo, hi in zip(cuts, cuts[1:])), key=lambda x: x[0])
        if best[0] <= 1e-9:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(g))
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = (G[hi] - G[lo]) / (H[hi] - H[lo] + 1)
    return out


@dataclass
class Gam:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        if self.edges and len(x):
            b = self.bins(x)
            for k, t in enumerate(self.tables):
                z += t[b[:, k]]
            for i, j, t in self.pairs:
                z += t[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    if not len(y):
        return Gam(0.0)
    mean = float(y.mean())
    if mean in (0.0, 1.0):
        return Gam(float(np.log((mean * len(y) + 0.5) / ((1 - mean) * len(y) + 0.5))))
    model = Gam(float(np.log(mean / (1 - mean))))
    for k in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])))
        model.tables.append(np.zeros(len(model.edges[-1]) + 1))
    b = model.bins(x)
    z = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, t in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b[:, k], g, len(t)), np.bincount(b[:, k], h, len(t)), LEAVES)
            t += step
            z += step[b[:, k]]
    g, h = slopes()
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i):
            cell = 2 * (b[:, i] > len(model.edges[i]) // 2) + (b[:, j] > len(model.edges[j]) // 2)
            gs, hs = np.bincount(cell, g, 4), np.bincount(cell, h, 4)
            ranked.append((float((gs ** 2 / (hs + 1)).sum()), i, j))
    for _, i, j in sorted(ranked, reverse=True)[:PAIRS]:
        model.pairs.append((i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))))
    for _ in range(PAIR_ROUNDS):
        for i, j, t in model.pairs:
            g, h = slopes()
            flat = b[:, i] * t.shape[1] + b[:, j]
            gs = np.bincount(flat, g, t.size).reshape(t.shape)
            hs = np.bincount(flat, h, t.size).reshape(t.shape)
            # two leaves along i, in each of them two along j
            top = _tree(gs.sum(1), hs.sum(1), 2)
            step = np.zeros_like(t)
            for leaf in np.unique(top):
                rows = top == leaf
                step[rows] = _tree(gs[rows].sum(0), hs[rows].sum(0), 2)
            t += RATE * step
            z += RATE * step[b[:, i], b[:, j]]
    return model


def _feature_fn():
    schema = pa.schema([("y", pa.int32()), ("x", pa.list_(pa.float64()))])
    return arrow_map(lambda c: {"y": c["y"], "x": [features(t) for t in c["text"]]}, schema)


def held_out(doc_id: str) -> Column:
    """Rows that are never learned from: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Gam:
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
              .where("doc_id IS NOT NULL AND y IN (0, 1)").where(~held_out("doc_id")))
    picked = (usable.where(hash_share(2 * rows, usable.count(), "doc_id")).distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most ``rows`` pairs of numbers are broadcast
    got = (known.join(F.broadcast(picked), "doc_id").select("y", "text")
           .mapInArrow(_feature_fn(), "y int, x array<double>").limit(rows).toPandas())
    if not len(got):
        return Gam(0.0)
    x = np.stack([np.asarray(v) for v in got["x"]])
    order = np.lexsort(x.T)       # the order in which rows arrive is not fixed
    return fit(x[order], got["y"].to_numpy(dtype=np.float64)[order])


def quality_score(model: Gam, text):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        at_work("quality")
        x = np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))
        return pd.Series(model.score(x))

    return score(text)


def classify_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = train(spark, docs, labels)
    return (docs.select("doc_id", held_out("doc_id").alias("held_out"),
                        quality_score(model, F.col("text").cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents predicted good, columns unchanged."""
    model = train(spark, docs, labels)
    name = free_name(docs, "quality_score")
    return (docs.withColumn(name, quality_score(model, F.col("text").cast("string")))
            .where(F.col(name) >= threshold).drop(name))

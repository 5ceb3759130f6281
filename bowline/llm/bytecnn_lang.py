"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths slide over a fixed-length window,
each filter keeps its largest response in the window, and a softmax layer turns
the pooled responses into language probabilities. Forward, backward and Adam
updates are numpy, fitted on one window each of at most ``TRAIN_ROWS`` labelled
documents (smallest hash of doc_id): a bounded sample and documented parameter.

Scoring cuts every whole text into windows of ``WINDOW`` bytes (the last one
padded) and runs them in batches. As a filter's response is a sum over its bytes,
embedding and filters are folded into tables indexed by byte pairs, so a window
costs two lookups a byte for all widths together. A document's probabilities are
the mean over its windows, weighted by their bytes.

Defined results: ``und`` with score 0 for null, empty and letterless texts and
when there was nothing to learn from. Ties go to the language that sorts first.
Repeated rows and extra columns change nothing; null doc_ids are never learned
from, but predicted.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bowline.llm.common import SLICE_ROWS, at_work, free_name, hash_share

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
TRAIN_ROWS = 6000
EPOCHS = 5
BATCH = 32
RATE = 0.01
SEED = 11
BATCH_WINDOWS = 64       # windows scored at a time
MIN_SCORE = 0.3          # documents below are rejected by ``keep_known``

_LETTER = re.compile(r"[^\W\d_]")


def windows_of(raw: bytes, window: int = WINDOW) -> np.ndarray:
    n = max(1, -(-len(raw) // window))
    return np.frombuffer(raw.ljust(n * window, b"\0"), np.uint8).reshape(n, window)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Net:
    langs: list[str]
    embed: np.ndarray                  # 256 x EMBED
    filters: list[np.ndarray]          # each (width * EMBED) x FILTERS
    bias: np.ndarray                   # all filters
    out: np.ndarray                    # (all filters + 1) x languages

    def folded(self) -> "Folded":
        """Tables by byte pair: responses of each width's first two bytes, and
        of what follows (one byte of width 3, two bytes of width 4)."""
        part = [[self.embed @ f[k * EMBED:(k + 1) * EMBED] for k in range(w)] for w, f in zip(WIDTHS, self.filters)]

        def pair(a, b):
            return (a[:, None, :] + b[None, :, :]).reshape(65536, -1)

        zero = np.zeros((256, FILTERS))
        first = np.concatenate([pair(p[0], p[1]) for p in part], axis=1) + self.bias
        second = np.concatenate([pair(part[1][2], zero), pair(part[2][2], part[2][3])], axis=1)
        return Folded(self.langs, first.astype(np.float32), second.astype(np.float32), self.out)


@dataclass
class Folded:
    langs: list[str]
    first: np.ndarray
    second: np.ndarray
    out: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of windows (n x WINDOW bytes)."""
        res = np.empty((len(x), len(self.langs)))
        for lo in range(0, len(x), BATCH_WINDOWS):
            b = x[lo:lo + BATCH_WINDOWS].astype(np.intp)
            code = b[:, :-1] * 256 + b[:, 1:]
            resp = self.first[code[:, :-2]]
            resp[:, :, FILTERS:] += self.second[code[:, 2:]]
            h = np.maximum(resp.max(axis=1), 0)
            res[lo:lo + BATCH_WINDOWS] = _softmax(h @ self.out[:-1] + self.out[-1])
        return res

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        for text in texts:      # one encoded text at a time
            if not self.langs or not text or not _LETTER.search(text):
                out.append(("und", 0.0))
                continue
            raw = text.encode("utf-8", "surrogatepass")
            win = windows_of(raw)
            weight = np.full(len(win), float(WINDOW))
            weight[-1] = len(raw) - WINDOW * (len(win) - 1)
            p = weight @ self.probabilities(win) / weight.sum()
            k = int(p.argmax())
            out.append((self.langs[k], float(min(1.0, p[k]))))
        return out


def fit(raws: list[bytes], langs: list[str]) -> Net:
    names = sorted(set(langs))
    x = np.concatenate([windows_of(r[:WINDOW]) for r in raws]).astype(np.intp)
    y = np.array([names.index(v) for v in langs])
    rng = np.random.default_rng(SEED)
    params = [rng.normal(0, 0.3, (256, EMBED)),
              *[rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)) for w in WIDTHS],
              np.zeros(FILTERS * len(WIDTHS)),
              np.concatenate([rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(names))), np.zeros((1, len(names)))])]
    mom, var, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            t += 1
            for p, g, m, v in zip(params, _gradients(params, x[pick], y[pick]), mom, var):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Net(names, params[0], params[1:1 + len(WIDTHS)], params[-2], params[-1])


def _gradients(params: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    embed, bias, out = params[0], params[-2], params[-1]
    n, e = len(x), embed[x]                              # n x WINDOW x EMBED
    cols, pos, pooled = [], [], []
    for k, w in enumerate(WIDTHS):
        c = np.concatenate([e[:, i:x.shape[1] - w + 1 + i] for i in range(w)], axis=2)
        r = c @ params[1 + k] + bias[k * FILTERS:(k + 1) * FILTERS]
        cols.append(c)
        pos.append(r.argmax(axis=1))                     # n x FILTERS
        pooled.append(r.max(axis=1))
    pre = np.concatenate(pooled, axis=1)
    h = np.maximum(pre, 0)
    d = _softmax(h @ out[:-1] + out[-1])
    d[np.arange(n), y] -= 1
    d /= n
    g_out = np.concatenate([h.T @ d, d.sum(0, keepdims=True)])
    dh = (d @ out[:-1].T) * (pre > 0)
    g_embed, g_filters = np.zeros_like(embed), []
    rows = np.arange(n)[:, None]
    for k, w in enumerate(WIDTHS):
        dk = dh[:, k * FILTERS:(k + 1) * FILTERS]        # n x FILTERS
        at = cols[k][rows, pos[k]]                       # n x FILTERS x (w * EMBED)
        g_filters.append(np.einsum("nf,nfc->cf", dk, at))
        back = dk[:, :, None] * params[1 + k].T[None]    # n x FILTERS x (w * EMBED)
        for i in range(w):
            np.add.at(g_embed, x[rows, pos[k] + i], back[:, :, i * EMBED:(i + 1) * EMBED])
    return [g_embed, *g_filters, dh.sum(0), g_out]


def held_out(doc_id: str) -> Column:
    """Rows that are never learned from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, rows: int = TRAIN_ROWS) -> Folded:
    """Learns from one window, at a hashed place, of each sampled text."""
    text = F.col("text").cast("string")
    at = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.greatest(F.length(text) - WINDOW, F.lit(1))) + 1
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    total = known.select("doc_id").count()
    got = (known.where(hash_share(2 * rows, total, "doc_id") & text.rlike(r"\p{L}"))
           .select(F.xxhash64("doc_id").alias("h"), F.col("doc_id").cast("long").alias("doc_id"),
                   F.col("lang").cast("string").alias("lang"),
                   F.substring(text, at.cast("int"), F.lit(WINDOW)).alias("text"))
           .orderBy("h", "doc_id", "lang", "text").limit(rows).toPandas())
    if not len(got):
        return Folded([], np.zeros((65536, 0), np.float32), np.zeros((65536, 0), np.float32), np.zeros((1, 0)))
    return fit([t.encode("utf-8", "surrogatepass") for t in got["text"]], list(got["lang"])).folded()


def language(spark: SparkSession, net: Folded, text) -> Column:
    """Struct column (lang_pred, score) of a text column; the tables, 20 MB at
    every size of input, are broadcast."""
    shared = spark.sparkContext.broadcast(net)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        at_work("language")
        return pd.DataFrame(shared.value.predict(list(texts)), columns=["lang_pred", "score"])

    return predict(text)


def identify_languages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score. Texts go to the worker in small
    pieces, and no row waits in the executor for its result to come back."""
    shared = spark.sparkContext.broadcast(train(spark, docs))

    def score(batches):
        at_work("language")
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                found = shared.value.predict(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    out = T.StructType([*rows.schema.fields[:2], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(score, out)


def keep_known(spark: SparkSession, docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents in a recognised language (any, if nothing was learned),
    columns unchanged."""
    net = train(spark, docs)
    if not net.langs:
        return docs
    name = free_name(docs, "language")
    return (docs.withColumn(name, language(spark, net, F.col("text").cast("string")))
            .where((F.col(name)["lang_pred"] != "und") & (F.col(name)["score"] >= min_score)).drop(name))

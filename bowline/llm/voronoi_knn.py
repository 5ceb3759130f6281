"""Exact top-k inner products by a Voronoi join.

Pivots (data vectors, a bounded sample by hash) cut the space into Voronoi
cells; queries and data are grouped by their nearest pivot. Each data cell is
summarised by its pivot, its radius and its largest norm. For a query q and a
cell with pivot p and radius r, no vector of the cell scores above
``min(q.p + |q| r, |q| * largest norm)``; the pivots themselves are data, so the
k-th best score among them is a score the query surely reaches. A query is sent
only to the cells whose bound is not below that score (the smaller side is the
one replicated), grouped by its own cell so that queries meeting the same cells
travel together; cells are solved locally in blocks of at most ``BLOCK_ROWS``
vectors by ``BLOCK_QUERIES`` queries with exact integer products, and the blocks'
best are merged per query.

Only pivots and summaries (at most ``MAX_PIVOTS`` rows) are broadcast. A cell
that holds a third of all rows, copies of one vector included, is many blocks.

Defined results: components are floor(scale * x); vectors that are null or hold
null, NaN or infinite components take no part; shorter vectors count as padded
with zeros. Rows that share a vec_id are candidates each, never for a query of
that id; repeated query rows count once (the largest vector in array order).
Null ids take no part. Extra columns are ignored. Fewer candidates than k: all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bowline.llm.common import Scratch, arrow_map, hash_share

K = 5
SCALE = 256
QUERY_EVERY = 50
MAX_PIVOTS = 256
BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048


def integer_vectors(emb: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the rows that take part, components floor(scale * x)."""
    x = F.col("embedding")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                     & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return (emb.where(F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(whole, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v")))


def _matrix(vs, dim: int) -> np.ndarray:
    out = np.zeros((len(vs), dim), np.int64)
    for k, v in enumerate(vs):
        out[k, :len(v)] = v
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where every partial sum is below
    2**53, in 64-bit integers otherwise."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2 ** 53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


def _cell_fn(pivots, dim: int):
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("cell", pa.int32()),
                        ("far", pa.float64()), ("norm", pa.float64())])

    def fn(cols):
        p = pivots.value[1].astype(np.float64)
        x = _matrix(cols["v"], dim).astype(np.float64)
        near = ((p ** 2).sum(1)[None] - 2 * x @ p.T).argmin(axis=1)
        return {"vec_id": cols["vec_id"], "v": cols["v"], "cell": near.astype(np.int32),
                "far": _norms(x - p[near]), "norm": _norms(x)}

    return arrow_map(fn, schema)


def _send_fn(pivots, summary, dim: int, k: int):
    """For each query the cells that can hold one of its k best."""
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("home", pa.int32()),
                        ("cell", pa.int32())])

    def fn(cols):
        ids, p = pivots.value
        cell, far, norm = summary.value
        q = _matrix(cols["v"], dim)
        own = np.asarray(cols["vec_id"], np.int64)
        s = _products(q, p).astype(np.float64)
        sure = np.where(ids[None] == own[:, None], -np.inf, s)
        floor = np.sort(sure, axis=1)[:, -k] if len(ids) > k else np.full(len(q), -np.inf)
        size = _norms(q)[:, None]
        bound = np.minimum(s[:, cell] + size * far[None], size * norm[None])
        # a margin for rounding in the radii and norms
        take = bound * (1 + 1e-9 * np.sign(bound)) + 1e-3 >= floor[:, None]
        i, j = np.nonzero(take)
        return {"vec_id": own[i], "v": [cols["v"][a] for a in i.tolist()],
                "home": np.asarray(cols["cell"], np.int32)[i], "cell": cell[j].astype(np.int32)}

    return arrow_map(fn, schema)


def _solve(dim: int, k: int):
    def run(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        cols = {"query_id": [], "vec_id": [], "score": []}
        if len(data) and len(queries):
            ids = data["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")       # ties go to the smaller id
            ids, x = ids[order], _matrix([data["v"].iloc[a] for a in order], dim)
            qid, q = queries["vec_id"].to_numpy(), _matrix(list(queries["v"]), dim)
            for lo in range(0, len(q), 256):
                s = _products(q[lo:lo + 256], x)
                for row, me in zip(s, qid[lo:lo + 256]):
                    at = np.flatnonzero(ids != me)
                    if len(at) > k:
                        floor = np.partition(row[at], -k)[-k]
                        at = at[row[at] >= floor]
                        at = at[np.argsort(-row[at], kind="stable")][:k]
                    cols["query_id"] += [me] * len(at)
                    cols["vec_id"] += ids[at].tolist()
                    cols["score"] += row[at].tolist()
        return pd.DataFrame(cols).astype("int64")

    return run


def top_k(spark: SparkSession, emb: DataFrame, queries: Column | None = None, k: int = K, scale: int = SCALE,
          max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """Each query's k highest scores: query_id, rank, vec_id, score. ``queries``
    is a condition on vec_id (by default divisible by QUERY_EVERY)."""
    is_query = queries if queries is not None else F.col("vec_id") % QUERY_EVERY == 0
    out_schema = "query_id long, rank int, vec_id long, score long"
    scratch = Scratch(spark, "voronoi")
    vecs = integer_vectors(emb, scale)
    n, dim = vecs.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], out_schema)
    want = min(max_pivots, max(1, int(n ** 0.5)))
    # distinct vectors, so that copies of one do not crowd out the others
    picked = (vecs.where(hash_share(16 * want, n, "vec_id")).groupBy("v").agg(F.min("vec_id").alias("vec_id"))
              .orderBy(F.xxhash64("vec_id"), "vec_id").limit(want).collect())
    pivots = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in picked], np.int64),
                                           _matrix([r["v"] for r in picked], dim)))
    data = scratch.write(vecs.mapInArrow(
        _cell_fn(pivots, dim), "vec_id long, v array<long>, cell int, far double, norm double"), "cells")
    cells = data.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("far").alias("far"),
                                     F.max("norm").alias("norm")).orderBy("cell").collect()
    summary = spark.sparkContext.broadcast((np.array([r["cell"] for r in cells], np.int64),
                                            np.array([r["far"] for r in cells]),
                                            np.array([r["norm"] for r in cells])))
    asked = data.where(is_query).groupBy("vec_id").agg(F.max(F.struct("v", "cell")).alias("s")) \
        .select("vec_id", "s.v", "s.cell")
    sent = scratch.write(asked.mapInArrow(_send_fn(pivots, summary, dim, k),
                                          "vec_id long, v array<long>, home int, cell int"), "sent")
    # blocks: both sides of a cell are dealt evenly, and each pair of blocks meets once
    load = sent.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_QUERIES)).cast("long").alias("qbs"))
    held = data.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).cast("long").alias("dbs"))
    plan = F.broadcast(load.join(held, "cell"))      # at most a row for each pivot
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    left = (data.join(plan, "cell").withColumn("db", F.pmod(F.xxhash64("vec_id", "v"), "dbs"))
            .withColumn("qb", F.explode(F.sequence(zero, F.col("qbs") - one))).select("cell", "db", "qb", "vec_id", "v"))
    right = (sent.join(plan, "cell").withColumn("qb", F.pmod(F.xxhash64("home", "vec_id"), "qbs"))
             .withColumn("db", F.explode(F.sequence(zero, F.col("dbs") - one))).select("cell", "db", "qb", "vec_id", "v"))
    keys = ["cell", "db", "qb"]
    best = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInPandas(_solve(dim, k), "query_id long, vec_id long, score long"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

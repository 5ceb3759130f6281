"""Micro corpora (FIXTURES.md section 3) and brute-force references in NumPy."""

from __future__ import annotations

import math

import numpy as np

from bowline.sources.corpus import CellCorpus

# micro_counts: 3 classes, 6 documents, 5 terms (rows = documents, columns = terms)
MICRO_COUNTS = np.array([
    [2, 1, 0, 0, 0],
    [3, 0, 1, 0, 0],
    [0, 2, 2, 1, 0],
    [0, 0, 3, 1, 1],
    [1, 0, 0, 4, 2],
    [0, 1, 0, 2, 3],
])
MICRO_CLASSES = np.array([1, 1, 2, 2, 3, 3])


def cell_corpus(spark, counts, classes=None, ids=None):
    ids = list(range(len(counts))) if ids is None else ids
    cells, rows = [], []
    for r, row in enumerate(counts):
        cid = None if classes is None else (None if classes[r] is None else int(classes[r]))
        rows.append((int(ids[r]), cid))
        for t, c in enumerate(row):
            if c:
                cells.append((int(ids[r]), cid, int(t), int(c)))
    cdf = spark.createDataFrame(cells, "doc_id bigint, class_id int, term int, cnt bigint")
    rdf = spark.createDataFrame(rows, "doc_id bigint, class_id int")
    return CellCorpus(cdf, rdf)


def nb_reference(train, train_y, test, k, beta=None, V=None):
    """Dense NumPy Naive Bayes with log2 likelihoods, as specified."""
    V = V or train.shape[1]
    beta = beta if beta is not None else 1.0 / V
    wc = np.zeros((k, train.shape[1]))
    nd = np.zeros(k)
    for y in range(1, k + 1):
        wc[y - 1] = train[train_y == y].sum(axis=0)
        nd[y - 1] = (train_y == y).sum()
    W = wc.sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore"):
        lik = np.log2((wc + beta) / (W + beta * V))
        prior = np.log2(nd / nd.sum())
    scores = test @ lik.T + prior
    return scores, np.argmax(scores, axis=1) + 1


def lr_reference_step(X, Y, W, k, eta, lam):
    """Dense step; X has the bias column first; W is k x (n+1)."""
    Z = W @ X.T
    E = np.exp(Z)
    E[-1, :] = 1
    P = E / np.abs(E).sum(axis=0, keepdims=True)
    D = np.zeros((k, X.shape[0]))
    for i, y in enumerate(Y):
        D[y - 1, i] = 1
    return W + eta * ((D - P) @ X - lam * W), P


def entropy(p):
    return -sum(x * math.log2(x) for x in p if x > 0)

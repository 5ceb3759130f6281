import math

import numpy as np
import pytest

from bowline.operators import evaluate as E
from bowline.operators.naive_bayes import nb_beta_sweep, nb_fit, nb_predict, nb_scores
from bowline.sources.corpus import ClassSet

from fixtures import MICRO_CLASSES, MICRO_COUNTS, cell_corpus, nb_reference

CLASSES3 = ClassSet(("a", "b", "c"))


def _scores(df, k):
    return {r["doc_id"]: [r[f"s_{j}"] for j in range(1, k + 1)] for r in df.collect()}


def test_fit_and_scores_match_numpy(spark):
    train = cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES)
    test_counts = np.array([[1, 0, 0, 0, 1], [0, 0, 2, 0, 0], [0, 3, 0, 1, 0]])
    test = cell_corpus(spark, test_counts, [None, None, None], ids=[100, 101, 102])
    model = nb_fit(train, CLASSES3, extra_vocab=[test])
    assert model.vocab_size == 5
    ref_scores, ref_pred = nb_reference(MICRO_COUNTS, MICRO_CLASSES, test_counts, 3)
    got = _scores(nb_scores(model, test), 3)
    for i, doc in enumerate([100, 101, 102]):
        assert np.allclose(got[doc], ref_scores[i], rtol=1e-12)
    preds = {r["doc_id"]: r["predicted"] for r in nb_predict(model, test).collect()}
    assert [preds[d] for d in (100, 101, 102)] == list(ref_pred)


def test_unseen_terms_use_shared_vocabulary(spark):
    # term 5 never occurs in training: V = 6, the unseen likelihood applies
    train = cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES)
    test_counts = np.array([[0, 0, 0, 0, 0, 4]])
    test = cell_corpus(spark, test_counts, [None], ids=[7])
    model = nb_fit(train, CLASSES3, extra_vocab=[test])
    assert model.vocab_size == 6
    padded = np.hstack([MICRO_COUNTS, np.zeros((6, 1), dtype=int)])
    ref_scores, _ = nb_reference(padded, MICRO_CLASSES, test_counts, 3)
    assert np.allclose(_scores(nb_scores(model, test), 3)[7], ref_scores[0], rtol=1e-12)
    # 'train' vocabulary ignores the unknown term: prior only
    only_prior = _scores(nb_scores(model, test, vocab="train"), 3)[7]
    assert np.allclose(only_prior, [math.log2(2 / 6)] * 3)


def test_document_without_terms_gets_prior_only_class(spark):
    train = cell_corpus(spark, MICRO_COUNTS, np.array([1, 2, 2, 2, 3, 3]))
    test = cell_corpus(spark, np.zeros((1, 5), dtype=int), [None], ids=[1])
    model = nb_fit(train, CLASSES3)
    assert nb_predict(model, test).first()["predicted"] == 2


def test_tie_lowest_class_wins(spark):
    counts = np.array([[1, 0], [1, 0]])
    train = cell_corpus(spark, counts, np.array([1, 2]))
    test = cell_corpus(spark, np.array([[1, 0]]), [None], ids=[0])
    model = nb_fit(train, ClassSet(("x", "y")))
    assert nb_predict(model, test).first()["predicted"] == 1


def test_empty_class_never_predicted_and_zero_row(spark):
    train = cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES)
    classes = ClassSet(("a", "b", "c", "d"))
    model = nb_fit(train, classes)
    assert model.log_prior()[3] == float("-inf")
    preds = nb_predict(model, train)
    assert all(r["predicted"] != 4 for r in preds.collect())
    cm = {(r["predicted"], r["actual"]): r["n"] for r in E.confusion_matrix(preds, classes).collect()}
    assert len(cm) == 16
    assert sum(cm[(4, a)] for a in range(1, 5)) == 0
    assert sum(cm.values()) == 6
    acc = E.accuracy(preds).first()["accuracy"]
    assert acc == pytest.approx(sum(cm[(j, j)] for j in range(1, 5)) / 6)


def test_nan_score_counts_as_largest(spark):
    from bowline.functions.numeric import argmax_1based
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1.0, float("nan"), 3.0), (2.0, 2.0, 1.0)], "a double, b double, c double")
    got = [r[0] for r in df.select(argmax_1based([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert got == [2, 1]


def test_beta_sweep_matches_single_fits(spark):
    train = cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES)
    test = cell_corpus(spark, MICRO_COUNTS[::-1], list(MICRO_CLASSES[::-1]), ids=list(range(50, 56)))
    model = nb_fit(train, CLASSES3, extra_vocab=[test])
    sweep = nb_beta_sweep(model, test, betas=(0.001, 0.5))
    for beta in (0.001, 0.5):
        _, ref = nb_reference(MICRO_COUNTS, MICRO_CLASSES, MICRO_COUNTS[::-1], 3, beta=beta)
        got = {r["doc_id"]: r["predicted"] for r in sweep.where(f"beta = {beta}").collect()}
        assert [got[d] for d in range(50, 56)] == list(ref)


def test_three_hundred_classes_match_numpy(spark):
    """No limit on the number of classes; the same result as brute force."""
    rng = np.random.default_rng(3)
    k = 300
    counts = rng.integers(0, 4, (k + 40, 6))
    classes = np.concatenate([np.arange(1, k + 1), rng.integers(1, k + 1, 40)])
    names = ClassSet.from_labels(spark.createDataFrame([(f"c{j:03d}",) for j in range(k)], "label string"), "label")
    assert names.k == k
    train = cell_corpus(spark, counts, classes)
    test = cell_corpus(spark, counts[:5], [None] * 5, ids=range(1000, 1005))
    model = nb_fit(train, names)
    ref_scores, _ = nb_reference(counts, classes, counts[:5], k)
    got = _scores(nb_scores(model, test), k)
    assert all(np.allclose(got[1000 + i], ref_scores[i], rtol=1e-12) for i in range(5))


def test_sweep_ignores_unknown_terms_with_training_vocabulary(spark):
    train = cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES)
    test = cell_corpus(spark, np.array([[0, 0, 0, 0, 0, 4], [1, 0, 0, 3, 0, 9], [0] * 6]), [None] * 3, ids=[7, 8, 9])
    model = nb_fit(train, CLASSES3, extra_vocab=[test])
    for vocab in ("shared", "train"):
        sweep = {(r["beta"], r["doc_id"]): r["predicted"]
                 for r in nb_beta_sweep(model, test, betas=(0.01, 1.0), vocab=vocab).collect()}
        for beta in (0.01, 1.0):
            single = nb_predict(model.with_beta(beta), test, vocab)
            assert {r["doc_id"]: r["predicted"] for r in single.collect()} == \
                {d: p for (b, d), p in sweep.items() if b == beta}
    assert model.vocab_size == 6


def test_scores_without_any_broadcast(spark):
    """The plan beyond the broadcast limit; empty documents keep their row."""
    train = cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES)
    test = cell_corpus(spark, np.vstack([MICRO_COUNTS, np.zeros((1, 5), dtype=int)]), [None] * 7, ids=range(50, 57))
    model = nb_fit(train, CLASSES3)
    want = _scores(nb_scores(model, test), 3)
    sweep = sorted(map(tuple, nb_beta_sweep(model, test).collect()))
    spark.conf.set("bowline.broadcastLimitBytes", "1")
    try:
        got = _scores(nb_scores(model, test), 3)
        assert set(got) == set(range(50, 57)) and all(np.allclose(got[d], want[d], rtol=1e-12) for d in want)
        assert sorted(map(tuple, nb_beta_sweep(model, test).collect())) == sweep
    finally:
        spark.conf.unset("bowline.broadcastLimitBytes")

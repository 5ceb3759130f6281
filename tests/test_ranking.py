import math

import numpy as np
import pytest

from bowline.operators import logistic as L
from bowline.operators.naive_bayes import nb_fit
from bowline.operators.ranking import format_ranking, uncertain_documents, word_ranking
from bowline.sources.corpus import ClassSet

from fixtures import MICRO_CLASSES, MICRO_COUNTS, cell_corpus


def ranking_reference(counts, classes, k, beta, n, include_last=False):
    V = counts.shape[1]
    wc = np.zeros((k, V))
    nd = np.zeros(k)
    for y in range(1, k + 1):
        wc[y - 1] = counts[classes == y].sum(axis=0)
        nd[y - 1] = (classes == y).sum()
    W = wc.sum(axis=1, keepdims=True)
    avg = W.sum() / V
    tot = np.append(wc.sum(axis=0), nd.sum())
    sd = math.sqrt(((tot - avg) ** 2).sum() / V)
    keep = np.array([(avg - 2 * sd) <= t <= (avg + 2 * sd) for t in tot[:-1]])
    f = wc * keep
    p = (f + beta) / (W + beta)
    e = p * np.log2(p)
    rows = e if include_last else e[:-1]
    s = rows.sum(axis=0)
    order = sorted(range(V), key=lambda t: (round(s[t], 9), t))
    return [(t, -s[t]) for t in order[:n]]


def test_word_ranking_matches_reference(spark):
    # add a frequent term so the outlier filter removes something
    counts = np.hstack([MICRO_COUNTS, np.array([[40], [0], [35], [0], [50], [1]])])
    corpus = cell_corpus(spark, counts, MICRO_CLASSES)
    model = nb_fit(corpus, ClassSet(("a", "b", "c")))
    for include_last in (False, True):
        got = word_ranking(model, num_words=4, include_last_class=include_last).orderBy("rank").collect()
        ref = ranking_reference(counts, MICRO_CLASSES, 3, model.beta, 4, include_last)
        assert [r["term"] for r in got] == [t for t, _ in ref]
        assert np.allclose([r["score"] for r in got], [v for _, v in ref], rtol=1e-12)
        assert [r["rank"] for r in got] == [1, 2, 3, 4]
    line = format_ranking(word_ranking(model, num_words=1)).first()["line"]
    assert line.startswith("1. ")


def test_uniform_probabilities_entropy_and_gini(spark):
    k = 20
    rows = [(i, None) for i in range(3)]
    probs = spark.createDataFrame([(i, *[1.0 / k] * k) for i in range(3)],
                                  "doc_id long, " + ", ".join(f"p_{j} double" for j in range(1, k + 1)))
    out = uncertain_documents(probs, k, num_docs=2).collect()
    assert len(out) == 2
    assert out[0]["entropy"] == pytest.approx(4.32192809, abs=1e-8)
    assert out[0]["gini"] == pytest.approx(0.95, abs=1e-12)
    assert [r["doc_id"] for r in out] == [0, 1]


def test_zero_weights_give_uniform_probabilities(spark):
    corpus = cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES)
    feats = L.build_features(corpus, normalize=False)
    W = L.init_weights(feats, 3)
    p = L.probabilities(W, feats, 3).collect()
    for r in p:
        assert [r["p_1"], r["p_2"], r["p_3"]] == pytest.approx([1 / 3] * 3)


def test_ranking_by_word_and_text_round_trip(spark):
    from bowline.operators import ranking as R
    from bowline.operators.naive_bayes import nb_fit
    from bowline.sources.corpus import ClassSet
    from fixtures import MICRO_CLASSES, MICRO_COUNTS, cell_corpus
    model = nb_fit(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES), ClassSet(("a", "b", "c")))
    plain = {r["term"]: r["score"] for r in R.word_ranking(model, num_words=5).collect()}
    words = spark.createDataFrame([(i, f"w, {9 - i}") for i in range(4)], "term_id int, term string")
    named = R.word_ranking(model, num_words=5, words=words)
    got = {r["term"]: r["score"] for r in named.collect()}
    assert got == {("4" if t == 4 else f"w, {9 - t}"): s for t, s in plain.items()}
    lines = R.format_ranking(named).withColumnRenamed("line", "value")
    assert [tuple(r) for r in R.parse_ranking(lines).collect()] == [tuple(r) for r in named.collect()]

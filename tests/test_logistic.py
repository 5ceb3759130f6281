import numpy as np
import pytest

from bowline.operators import logistic as L
from bowline.sources.tables import SnapshotStore
from bowline.session import work_path

from fixtures import MICRO_CLASSES, MICRO_COUNTS, cell_corpus, lr_reference_step

K = 3


def dense_x(counts, normalize):
    X = np.hstack([np.ones((counts.shape[0], 1)), counts.astype(float)])
    if normalize:
        s = np.abs(X).sum(axis=0)
        X = np.where(s > 0, X / np.where(s > 0, s, 1), X)
    return X


def w_dense(W_df, n_terms, feats):
    W = np.zeros((K, n_terms + 1))
    for r in L.with_terms(W_df, feats).collect():
        col = 0 if r["term"] == "" else int(r["term"]) + 1
        for j in range(1, K + 1):
            W[j - 1, col] = r[f"w_{j}"]
    return W


def string_terms(corpus):
    from pyspark.sql import functions as F
    from bowline.sources.corpus import CellCorpus
    return CellCorpus(corpus.cell_frame.withColumn("term", F.col("term").cast("string")), corpus.row_frame)


@pytest.mark.parametrize("normalize", [False, True])
def test_steps_match_dense_reference(spark, normalize):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, normalize)
    W = L.init_weights(feats, K)
    X = dense_x(MICRO_COUNTS, normalize)
    Wd = np.zeros((K, X.shape[1]))
    eta, lam = (0.05, 0.01) if normalize else (0.001, 0.01)
    for _ in range(3):
        W = L.gradient_step(W, feats, K, eta, lam)
        Wd, _ = lr_reference_step(X, MICRO_CLASSES, Wd, K, eta, lam)
    assert np.allclose(w_dense(W, 5, feats), Wd, rtol=1e-10, atol=1e-14)
    probs = L.probabilities(W, feats, K).orderBy("doc_id").collect()
    _, P = lr_reference_step(X, MICRO_CLASSES, Wd, K, eta, lam)
    got = np.array([[r[f"p_{j}"] for j in range(1, K + 1)] for r in probs]).T
    assert np.allclose(got, P, rtol=1e-10)
    assert np.allclose(got.sum(axis=0), 1.0)


def test_last_row_never_changes_probabilities(spark):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, False)
    W = L.gradient_step(L.init_weights(feats, K), feats, K, 0.001, 0.01)
    from pyspark.sql import functions as F
    W2 = W.withColumn("w_3", F.col("w_3") + 5.0)
    a = L.probabilities(W, feats, K).orderBy("doc_id").collect()
    b = L.probabilities(W2, feats, K).orderBy("doc_id").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_stable_softmax_same_result(spark):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, False)
    W = L.gradient_step(L.init_weights(feats, K), feats, K, 0.01, 0.01)
    a = L.probabilities(W, feats, K).orderBy("doc_id").collect()
    b = L.probabilities(W, feats, K, stable=True).orderBy("doc_id").collect()
    for x, y in zip(a, b):
        assert [x[f"p_{j}"] for j in range(1, 4)] == pytest.approx([y[f"p_{j}"] for j in range(1, 4)], rel=1e-9)


def test_normalize_weights_and_diagnostics(spark):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, True)
    W = L.gradient_step(L.init_weights(feats, K), feats, K, 0.05, 0.01, normalize_w=True)
    d = L.weight_diagnostics(W, K).first()
    assert d["abs_sum"] == pytest.approx(1.0)
    zero = L.init_weights(feats, K)
    assert L.normalize_weights(zero, K) is zero


def test_training_loop_history_snapshots_and_resume(spark):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, False)
    plan = L.Schedule(5, log_every=1, save_every=2, check_every=1)
    store = SnapshotStore(spark, work_path(spark, "tests", "snap-" + __import__("uuid").uuid4().hex))
    res = L.train(feats, feats, K, plan, 0.001, 0.01, snapshots=store)
    assert res.saved == [2, 4, 5]            # cadence 2, remainder 1
    assert [h[0] for h in res.history] == [1, 2, 3, 4, 5]
    # resume from the latest snapshot equals a straight run
    W5, it = store.load()
    assert it == 5
    res2 = L.train(feats, None, K, L.Schedule(2), 0.001, 0.01, W=W5, snapshots=store)
    assert res2.saved == [7]
    straight = L.train(feats, None, K, L.Schedule(7), 0.001, 0.01)
    assert np.allclose(w_dense(res2.W, 5, feats), w_dense(straight.W, 5, feats), rtol=1e-12)


def test_zero_iterations_only_evaluates(spark):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, False)
    res = L.train(feats, feats, K, L.Schedule(0))
    assert res.iterations == 0 and len(res.history) == 1


def test_schedule_and_stopping_rule():
    assert L.Schedule(5, log_every=100, save_every=2, check_every=4).events() == [
        (2, {"save"}), (4, {"save", "check"}), (5, set())]
    rule = L.StoppingRule(0.1)
    assert [rule.broken_by(a) for a in (0.5, 0.8, 0.71, 0.75, 0.69, 0.9)] == [False, False, False, False, True, False]


def test_early_stop(spark, monkeypatch):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, False)
    seen = iter([0.5, 0.5, 0.9, 0.5, 0.7, 0.5])          # validation, then training; the third check falls
    monkeypatch.setattr(L, "accuracy", lambda *a: next(seen))
    store = SnapshotStore(spark, work_path(spark, "tests", "stop-" + __import__("uuid").uuid4().hex))
    res = L.train(feats, feats, K, L.Schedule(30, save_every=2, check_every=1), 0.01, 0.0, max_drop=0.1, snapshots=store)
    assert res.stopped_early and res.iterations == 3
    assert res.history == [(1, 0.5, 0.5), (2, 0.5, 0.9)]
    assert res.saved == [2, 3] and store.committed() == [2, 3] and res.total_iter == 3


def test_unlabelled_documents_have_no_part_in_training(spark):
    """Weights equal those fitted on the labelled documents alone."""
    from bowline.sources.corpus import ClassSet, corpus_from_table
    rows = [(1, "a b b", "x"), (2, "b c", "y"), (3, "a a c", "x"), (4, "a b zzz", None), (5, "c c c", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    classes = ClassSet(("x", "y"))
    both = [L.build_features(corpus_from_table(d, classes, "label"), True) for d in (df, df.where("label IS NOT NULL"))]
    out = [sorted(map(tuple, L.weights_long(L.gradient_step(L.init_weights(f, 2), f, 2, 0.1, 0.01), 2, f)
                      .select("term", "class_id", "w").collect())) for f in both]
    assert both[0].m == 3 and out[0] == out[1]


def test_dictionary_keys_and_unknown_terms(spark):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, False)
    assert feats.n_terms == 6                     # five terms and the bias term
    assert isinstance(feats.bias_key, int)        # hashed keys, no collision
    # a scoring split with an unknown term: its cells are dropped, scores unchanged
    other = np.hstack([MICRO_COUNTS, np.full((6, 1), 7)])
    ext = string_terms(cell_corpus(spark, other, MICRO_CLASSES))
    efeats = L.build_features(ext, False, dictionary=feats)
    assert efeats.n_cells == feats.n_cells
    W = L.gradient_step(L.init_weights(feats, K), feats, K, 0.001, 0.01)
    a = L.probabilities(W, feats, K).orderBy("doc_id").collect()
    b = L.probabilities(W, efeats, K).orderBy("doc_id").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_score_latest_snapshot_and_write(spark):
    import uuid
    from bowline.sources.tables import read_predictions
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, False)
    store = SnapshotStore(spark, work_path(spark, "tests", "snap-" + uuid.uuid4().hex))
    L.train(feats, None, K, L.Schedule(3, save_every=3), 0.001, 0.01, snapshots=store)
    W, it = store.load()
    path = work_path(spark, "tests", "lrpred-" + uuid.uuid4().hex)
    L.write_split_predictions(W, feats, K, path, 0.001, 0.01, it)
    back = read_predictions(spark, path).collect()
    want = {r["doc_id"]: r["predicted"] for r in L.predictions(W, feats, K).collect()}
    assert {r["id"]: r["class"] for r in back} == want
    assert {r["iter"] for r in back} == {3}


def test_spread_layout_matches_bucketed(spark):
    counts = np.vstack([MICRO_COUNTS, np.arange(1, 6) * 3])
    classes = np.append(MICRO_CLASSES, 2)
    corpus = string_terms(cell_corpus(spark, counts, classes))
    bucketed = L.build_features(corpus, True, layout="bucketed")
    spread = L.build_features(corpus, True, layout="spread")
    assert spread.layout == "spread" and bucketed.layout == "bucketed"
    Wb = L.init_weights(bucketed, K)
    Ws = L.init_weights(spread, K)
    for _ in range(2):
        Wb = L.gradient_step(Wb, bucketed, K, 0.05, 0.01)
        Ws = L.gradient_step(Ws, spread, K, 0.05, 0.01)
    assert np.allclose(w_dense(Wb, 5, bucketed), w_dense(Ws, 5, spread), rtol=1e-12, atol=1e-15)
    # as many buckets as cells a document: one document is a straggler, 'auto' spreads
    assert L.build_features(corpus, True, partitions=100).layout == "spread"
    assert L.build_features(corpus, True, partitions=1).layout == "bucketed"


def test_norm_stats_from_training_split(spark):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, True)
    val_counts = MICRO_COUNTS[:3] * 2
    val = string_terms(cell_corpus(spark, val_counts, MICRO_CLASSES[:3], ids=[10, 11, 12]))
    vfeats = L.build_features(val, True, dictionary=feats, norm_stats="train")
    X = np.hstack([np.ones((6, 1)), MICRO_COUNTS.astype(float)])
    sums = np.abs(X).sum(axis=0)
    Xv = np.hstack([np.ones((3, 1)), val_counts.astype(float)]) / sums
    got = {(r["doc_id"], r["term"]): r["x"] for r in L.with_terms(vfeats.x, vfeats).collect()}
    for i, d in enumerate([10, 11, 12]):
        assert got[(d, "")] == pytest.approx(Xv[i, 0])
        for t in range(5):
            if val_counts[i, t]:
                assert got[(d, str(t))] == pytest.approx(Xv[i, t + 1])


def _two_steps(spark, counts=MICRO_COUNTS, classes=MICRO_CLASSES, **kw):
    feats = L.build_features(string_terms(cell_corpus(spark, counts, classes)), True, **kw)
    W = L.init_weights(feats, K)
    for _ in range(2):
        W = L.gradient_step(W, feats, K, 0.05, 0.01)
    return feats, W


@pytest.mark.parametrize("layout", ["bucketed", "spread"])
def test_without_any_broadcast(spark, layout):
    """The plans beyond the broadcast limit: the same weights and probabilities."""
    feats, W = _two_steps(spark, layout=layout)
    want, probs = w_dense(W, 5, feats), L.probabilities(W, feats, K).orderBy("doc_id").collect()
    spark.conf.set("bowline.broadcastLimitBytes", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feats, W = _two_steps(spark, layout=layout)
        plan = L.gradient_step_plan(W, feats, K, 0.05, 0.01)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
        assert np.allclose(w_dense(W, 5, feats), want, rtol=1e-12, atol=1e-15)
        got = L.probabilities(W, feats, K).orderBy("doc_id").collect()
        assert np.allclose([list(r)[2:] for r in got], [list(r)[2:] for r in probs], rtol=1e-12)
    finally:
        spark.conf.unset("bowline.broadcastLimitBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_shuffle_a_step(spark):
    """Bucketed features and a broadcast W: only the sums by term are exchanged."""
    feats, W = _two_steps(spark)
    plan = L.gradient_step_plan(W, feats, K, 0.05, 0.01)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange RoundRobin" not in plan


def test_string_keys_after_a_hash_collision(spark, monkeypatch):
    feats, W = _two_steps(spark)
    want = w_dense(W, 5, feats)
    from pyspark.sql import functions as F
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("bigint"))
    feats, W = _two_steps(spark)
    assert feats.bias_key == L.BIAS_TERM
    assert np.allclose(w_dense(W, 5, feats), want, rtol=1e-12, atol=1e-15)


def test_random_start(spark):
    feats, _ = _two_steps(spark)
    W = w_dense(L.init_weights(feats, K, random_initial=True, seed=7), 5, feats)
    assert W.shape == (3, 6) and len(set(W.ravel())) == 18 and 0 < np.abs(W).max() < 0.05

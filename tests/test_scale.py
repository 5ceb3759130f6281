"""What carries the models past one machine's widths: class blocks, co-bucketed
terms, sparse matrices, committed artefacts, long runs."""

import os
import subprocess
import sys
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from bowline.operators import class_blocks as CB
from bowline.operators import logistic as L
from bowline.operators import naive_bayes as NB
from bowline.session import work_path
from bowline.sources import matrix as M
from bowline.sources import models as MD
from bowline.sources import tables as T
from bowline.sources.corpus import ClassSet, corpus_from_table

from fixtures import MICRO_CLASSES, MICRO_COUNTS, cell_corpus, lr_reference_step, nb_reference
from test_logistic import dense_x, string_terms, w_dense

K = 3
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _path(spark, name):
    return work_path(spark, "tests", f"{name}-{os.urandom(4).hex()}")


# --- class blocks ------------------------------------------------------------------

def _widest(df):
    """Most columns of any node of the optimised plan."""
    todo, most = [df._jdf.queryExecution().optimizedPlan()], 0
    while todo:
        node = todo.pop()
        most = max(most, node.output().size())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def test_two_thousand_classes(spark):
    rng = np.random.default_rng(5)
    k, terms = 2000, 40
    counts = rng.poisson(0.15, (2600, terms))
    y = np.concatenate([np.arange(1, 1990), rng.integers(1, 1990, 611)])      # the last classes have no document
    test = np.vstack([rng.poisson(0.4, (25, terms)), np.zeros((1, terms), int)])
    classes = ClassSet(tuple(f"c{j:04d}" for j in range(1, k + 1)))
    train, unseen = cell_corpus(spark, counts, y), cell_corpus(spark, test, ids=range(9000, 9026))
    model = CB.fit_class_blocks(train, classes, vocab_size=terms)
    want, best = nb_reference(counts, y, test, k, V=terms)
    got = {r["doc_id"]: r["predicted"] for r in CB.predict_class_blocks(model, unseen).collect()}
    assert [got[9000 + i] for i in range(26)] == best.tolist()
    scores = CB.scores_class_blocks(model, unseen)
    assert len(model.counts.columns) < 100 and len(scores.columns) < 100 and _widest(scores) < 250
    for r in scores.where("doc_id IN (9000, 9025) AND block IN (0, 17, 31)").collect():
        for j in range(CB.BLOCK):
            c = r["block"] * CB.BLOCK + j
            have = r[f"s_{j + 1}"]
            assert have == pytest.approx(want[r["doc_id"] - 9000][c], abs=1e-9) if c < k and np.isfinite(
                want[r["doc_id"] - 9000][c]) else have == -np.inf


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_class_blocks_equal_the_wide_model(spark, block):
    train = cell_corpus(spark, np.vstack([MICRO_COUNTS, [[0, 0, 9, 0, 0]]]), [*MICRO_CLASSES, None])
    test = cell_corpus(spark, np.vstack([MICRO_COUNTS + 1, np.zeros((1, 5), int)]), ids=range(20, 27))
    classes = ClassSet(("a", "b", "c"))
    wide = NB.nb_fit(train, classes, [test])
    blocked = CB.fit_class_blocks(train, classes, block, [test])
    assert blocked.vocab_size == wide.vocab_size and blocked.beta == wide.beta
    a = {r["doc_id"]: r["predicted"] for r in NB.nb_predict(wide, test).collect()}
    b = {r["doc_id"]: r["predicted"] for r in CB.predict_class_blocks(blocked, test).collect()}
    assert a == b and len(a) == 7
    dense = {(r["class_id"], r["term"]): r["log_likelihood"] for r in wide.log_likelihood_long().collect()}
    for r in blocked.log_likelihood_long().collect():
        assert r["log_likelihood"] == pytest.approx(dense[(r["class_id"], r["term"])], abs=1e-12)
    spark.conf.set("bowline.broadcastLimitBytes", "1")
    try:
        assert {r["doc_id"]: r["predicted"] for r in CB.predict_class_blocks(blocked, test).collect()} == a
    finally:
        spark.conf.unset("bowline.broadcastLimitBytes")


# --- the step past the broadcast limit ---------------------------------------------------

def _exchanged(df):
    """Column names of every exchange of the physical plan."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        if "Exchange" in node.nodeName():
            names = node.output()
            out.append((node.nodeName(), [names.apply(i).name() for i in range(names.size())]))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_no_cell_moves_in_a_step_past_the_broadcast_limit(spark):
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.2, (60, 300)) + np.eye(60, 300, dtype=int)
    counts[:, 0] = 3                                   # a term that every document has
    y = rng.integers(1, K + 1, 60)
    corpus = string_terms(cell_corpus(spark, counts, y))
    feats = L.build_features(corpus, True, partitions=40)
    W = L.init_weights(feats, K, random_initial=True)
    want = [W := L.gradient_step(W, feats, K, 0.5, 0.01) for _ in range(2)][-1]
    probs = {r["doc_id"]: list(r)[2:] for r in L.probabilities(want, feats, K).collect()}
    spark.conf.set("bowline.broadcastLimitBytes", "8000")       # below W, above the hot terms
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not feats.broadcasts(K)
        W = L.init_weights(feats, K, random_initial=True)
        for _ in range(2):
            W = L.gradient_step(W, feats, K, 0.5, 0.01)
        assert np.allclose(w_dense(W, 300, feats), w_dense(want, 300, feats), rtol=1e-10, atol=1e-15)
        hot = {r["term"] for r in L.with_terms(feats.term_major().hot_keys, feats).collect()}
        assert {"", "0"} <= hot and len(hot) <= 2 * feats.buckets + 1
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        moved = _exchanged(L.gradient_step_plan(W, feats, K, 0.5, 0.01))
        assert moved and not any("x" in names for _, names in moved), moved
        got = {r["doc_id"]: list(r)[2:] for r in L.probabilities(W, feats, K).collect()}
        assert all(np.allclose(got[d], probs[d], rtol=1e-9) for d in probs)
    finally:
        for key in ("bowline.broadcastLimitBytes", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# --- training to the stopping rule -----------------------------------------------------------

def test_training_ends_by_itself_like_numpy(spark):
    """Dozens of steps until the held-out accuracy falls; one W is kept on disk."""
    rng = np.random.default_rng(10)
    train, val = rng.poisson(1.0, (24, 6)), rng.poisson(1.0, (40, 6))
    y, yv = np.arange(24) % K + 1, rng.integers(1, K + 1, 40)
    eta, lam, every, drop = 0.01, 0.005, 3, 0.04
    X, Xv, W = dense_x(train, False), dense_x(val, False), np.zeros((K, 7))

    def accuracy(X, y):
        P = lr_reference_step(X, y, W, K, 0, 0)[1]
        return float(np.mean(P.argmax(axis=0) + 1 == y))

    best, history, stopped = None, [], None
    for step in range(1, 200):
        W = lr_reference_step(X, y, W, K, eta, lam)[0]
        if step % every == 0:
            a = accuracy(Xv, yv)
            if best is not None and best - a > drop:
                stopped = step
                break
            best = a if best is None else max(best, a)
            history.append((step, accuracy(X, y), a))
    assert stopped and stopped >= 30
    feats = L.build_features(string_terms(cell_corpus(spark, train, y)), False)
    held = L.build_features(string_terms(cell_corpus(spark, val, yv, ids=range(100, 140))), False, dictionary=feats)
    tables = _files(spark, "tables")
    res = L.train(feats, held, K, L.Schedule(10_000, check_every=every), eta, lam, drop)
    assert res.stopped_early and res.iterations == stopped and res.history == history
    assert np.allclose(w_dense(res.W, 6, feats), W, rtol=1e-9)
    assert len(_files(spark, "tables") - tables) == 1


def _files(spark, name):
    fs, path = T._hadoop(spark, work_path(spark, name))
    return {st.getPath().getName() for st in fs.listStatus(path)}


def test_random_start_does_not_depend_on_partitions(spark):
    feats = L.build_features(string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES)), False)
    values = []
    for n in (1, 64):
        feats.terms = feats.terms.repartition(n)
        values.append(w_dense(L.init_weights(feats, K, random_initial=True), 5, feats))
    assert (values[0] == values[1]).all()
    many = spark.range(20_000).select(L.seeded_normal(1, 1, F.col("id").cast("string")).alias("z")).agg(
        F.avg("z"), F.stddev("z"), F.expr("avg(cast(abs(z) < 1.959964 as double))")).first()
    assert abs(many[0]) < 0.03 and abs(many[1] - 1) < 0.03 and abs(many[2] - 0.95) < 0.01


# --- matrices -------------------------------------------------------------------------------------

def test_sparse_matrix_round_trip(spark):
    rows = [(1, "b a b zzz", "x"), (2, "", "y"), (3, None, "x"), (4, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    vocabulary = spark.createDataFrame([(0, "a"), (1, "b"), (70_000, "c")], "term_id int, term string")
    path = _path(spark, "sparse")
    corpus = corpus_from_table(df, ClassSet(("x", "y")), "label")
    M.write_sparse_matrix(corpus, vocabulary, path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["1 1 0:1 1:2", "2 2", "3 1", "4 - 0:1"]
    back = M.read_sparse_matrix(spark, path)
    assert sorted(map(tuple, back.cells().collect())) == [(1, 1, 0, 1), (1, 1, 1, 2), (4, None, 0, 1)]
    assert sorted(map(tuple, back.rows().collect()), key=str) == sorted([(1, 1), (2, 2), (3, 1), (4, None)], key=str)


def test_malformed_rows_are_set_aside(spark, tmp_path):
    sparse = tmp_path / "sparse.txt"
    sparse.write_text("1 2 0:3 4:1\n\n2 1\n3\nx 1 0:1\n4 one 0:1\n5 1 0:1 7\n6 1 0:1:2\n7 - 2:0 3:5\n8 1 a:1\n9 1 2:many\n")
    scan = M.scan_sparse_matrix(spark, str(sparse))
    assert sorted(map(tuple, scan.corpus.cells().collect())) == [(1, 2, 0, 3), (1, 2, 4, 1), (7, None, 3, 5)]
    assert {r["reason"]: r["n"] for r in scan.counts().collect()} == {None: 3, "fields": 1, "id": 1, "class": 1, "count": 4}
    with pytest.raises(Exception, match="malformed count-matrix row"):
        M.read_sparse_matrix(spark, str(sparse)).cells().collect()
    dense = tmp_path / "dense.csv"
    dense.write_text("1,0, 2,1\n2,1,1\n3,1,1,1,1\nq,1,1,1\n4,1,1,z\n5,1,e,1\n")
    scan = M.scan_count_matrix(spark, str(dense), 2)
    assert [tuple(r) for r in scan.corpus.cells().collect()] == [(1, 1, 1, 2)]
    assert {r["reason"]: r["n"] for r in scan.counts().collect()} == {None: 1, "width": 2, "id": 1, "class": 1, "count": 1}
    assert {r["value"] for r in scan.rejects.where("reason = 'count'").collect()} == {"5,1,e,1"}
    plain = M.scan_count_matrix(spark, str(dense), 2, labelled=False)
    assert {r["reason"]: r["n"] for r in plain.counts().collect()} == {None: 1, "width": 5}
    (tmp_path / "none.txt").write_text("")
    assert M.scan_sparse_matrix(spark, str(tmp_path / "none.txt")).counts().collect()[0]["n"] == 0


def test_line_numbers_over_many_splits(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    words = [f"w{i:05d}" for i in range(4000)]
    for part, lo in enumerate(range(0, 4000, 1000)):
        (folder / f"part-{part:05d}-x.txt").write_text("".join(w + "\n" for w in words[lo:lo + 1000]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("bowline.broadcastLimitBytes", "1")
    try:
        vocabulary = M.read_vocabulary(spark, str(folder))
        plan = vocabulary._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
        assert [r["term"] for r in vocabulary.orderBy("term_id").collect()] == words
        assert vocabulary.select("term_id").distinct().count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("bowline.broadcastLimitBytes")


# --- committed artefacts ------------------------------------------------------------------------

def test_the_loser_of_a_race_reads_the_winner(spark):
    root = _path(spark, "race")
    spark.conf.set("bowline.workDir", root)
    ready = threading.Barrier(3)
    got = []

    def build(n):
        def frame():
            ready.wait(60)             # all have seen that there is no copy
            return spark.range(n)
        got.append(T.load_or_build(spark, "race", frame, "v1").count())

    try:
        threads = [threading.Thread(target=build, args=(n,)) for n in (5, 50, 500)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(set(got)) == 1 and got[0] in (5, 50, 500)
        fs, base = T._hadoop(spark, f"{root}/bowline/tables")
        held = fs.listStatus(fs.listStatus(base)[0].getPath())
        assert len([s for s in held if s.getPath().getName().startswith("data-")]) == 1
    finally:
        spark.conf.unset("bowline.workDir")


def test_publish_never_replaces(spark):
    root = _path(spark, "publish")
    spark.range(3).write.parquet(f"{root}/.a")
    spark.range(9).write.parquet(f"{root}/.b")
    assert T.publish(spark, f"{root}/.a", f"{root}/t") and not T.publish(spark, f"{root}/.b", f"{root}/t")
    assert spark.read.parquet(f"{root}/t").count() == 3 and not T._exists(spark, f"{root}/.b")
    store = T.SnapshotStore(spark, f"{root}/w")
    assert store.save(spark.range(4), 2) == 2 and store.load()[0].count() == 4
    assert T.publish_manifest(spark, f"{root}/m.json", {"v": 1}) == {"v": 1}
    assert T.publish_manifest(spark, f"{root}/m.json", {"v": 2}) == {"v": 1}
    assert T.read_manifest(spark, f"{root}/absent.json") is None


@pytest.mark.parametrize("normalize", [False, True])
def test_a_new_process_scores_from_the_bundle_alone(spark, normalize):
    docs = [(i, t, c) for i, (t, c) in enumerate([("red red apple", "fruit"), ("apple pear", "fruit"), ("blue car", "thing"),
                                                  ("fast car car", "thing"), ("red car", "thing")])]
    df = spark.createDataFrame(docs, "doc_id long, text string, label string")
    classes = ClassSet(("fruit", "thing"))
    feats = L.build_features(corpus_from_table(df, classes, "label"), normalize)
    W = L.train(feats, None, 2, L.Schedule(4), 0.1, 0.01).W
    root = _path(spark, "bundle")
    store = MD.ModelStore(spark, root)
    store.save(W, feats, classes, 4, 0.1, 0.01, normalize)
    store.save(L.init_weights(feats, 2), feats, classes, 2, 0.1, 0.01, normalize)
    # an iteration that is there stays as it is
    again = store.save(L.init_weights(feats, 2), feats, classes, 4, 0.1, 0.01, normalize)
    assert store.committed() == [2, 4] and again.weights.where("w_1 <> 0").count() > 0
    with pytest.raises(ValueError, match="no committed model 3"):
        store.load(3)
    new = [(10, "apple apple unknown"), (11, "car"), (12, None)]
    test = corpus_from_table(spark.createDataFrame(new, "doc_id long, text string"))
    stats = "train" if normalize else "split"
    want = {r["doc_id"]: r["predicted"] for r in L.predictions(
        W, L.build_features(test, normalize, dictionary=feats, norm_stats=stats), 2).collect()}
    assert {r["doc_id"]: r["predicted"] for r in store.load().predict(test, normalize, stats).collect()} == want
    assert {r["predicted_name"] for r in store.load().predict(test).collect()} <= {"fruit", "thing"}
    code = (f"from bowline.session import get_session; from bowline.sources.models import ModelStore\n"
            f"from bowline.sources.corpus import corpus_from_table\ns = get_session('local[1]')\n"
            f"c = corpus_from_table(s.createDataFrame({new!r}, 'doc_id long, text string'))\n"
            f"print('GOT', sorted((r.doc_id, r.predicted, r.predicted_name) for r in "
            f"ModelStore(s, {root!r}).load(4).predict(c, {normalize}, {stats!r}).collect()))")
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200, cwd=ROOT)
    names = {1: "fruit", 2: "thing"}
    assert f"GOT {sorted((d, p, names[p]) for d, p in want.items())}" in run.stdout, run.stderr[-2000:]
    out = _path(spark, "bundle-out")
    store.load(4).write_predictions(test, out, normalize=normalize, norm_stats=stats)
    back = T.read_predictions(spark, out).collect()
    assert {r["id"]: r["class"] for r in back} == want and {r["iter"] for r in back} == {4}


def test_a_tolerant_scan_parses_its_lines_once(spark, tmp_path):
    path = tmp_path / "m.txt"
    path.write_text("1 1 0:2 4:1\n2 1 0:x\n3\n4 - 2:5\n5 1 2:5:1\n6 2 3:0\n")
    scan = M.scan_sparse_matrix(spark, str(path))
    for df in (scan.corpus.cells(), scan.corpus.rows(), scan.rejects):
        assert "FileScan text" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, scan.corpus.cells().collect())) == [(1, 1, 0, 2), (1, 1, 4, 1), (4, None, 2, 5)]
    assert {(r["reason"], r["n"]) for r in scan.counts().collect()} == {(None, 3), ("count", 2), ("fields", 1)}


def test_the_strict_reader_reads_the_lines_once_and_refuses(spark, tmp_path):
    import pytest
    path = tmp_path / "m.txt"
    path.write_text("1 1 0:2\n2 x 0:1\n")
    back = M.read_sparse_matrix(spark, str(path))
    assert back.cells()._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    for job in (back.cells, back.rows):
        with pytest.raises(Exception, match="malformed"):
            job().count()


def test_matrix_lines_of_repeated_documents_move_once(spark, tmp_path):
    from bowline.sources.corpus import ClassSet, corpus_from_table
    rows = [(1, "a b a", "x"), (1, "b c", "x"), (2, "c", None), (3, "", "x"), (None, "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    vocabulary = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "term_id int, term string")
    path = M.write_sparse_matrix(corpus_from_table(df, ClassSet(("x",)), "label"), vocabulary, str(tmp_path / "out"))
    lines = sorted(r["value"] for r in spark.read.text(path).collect())
    assert lines == ["1", "1 1 0:2 1:2 2:1", "1 1 0:2 1:2 2:1", "2 - 2:1", "3 1"]

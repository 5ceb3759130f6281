"""Runs on term blocks: no step moves a cell or a weight."""

import numpy as np

from bowline.operators import logistic as L
from bowline.operators import term_blocks as TB

from fixtures import MICRO_CLASSES, MICRO_COUNTS, cell_corpus, lr_reference_step
from test_logistic import dense_x, string_terms, w_dense

K = 3


def test_run_matches_dense_reference_and_scores_other_splits(spark):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, True)
    more = np.hstack([MICRO_COUNTS[:4], np.full((4, 1), 3)])       # a term the training split has not
    other = L.build_features(string_terms(cell_corpus(spark, more, MICRO_CLASSES[:4])), False, dictionary=feats)
    run = L.run_steps(feats, K, 3, 0.05, 0.01, (other,))
    X, W = dense_x(MICRO_COUNTS, True), np.zeros((K, 6))
    for _ in range(3):
        W, _ = lr_reference_step(X, MICRO_CLASSES, W, K, 0.05, 0.01)
    assert np.allclose(w_dense(run.weights(), 5, feats), W, rtol=1e-10, atol=1e-14)
    z = np.hstack([(dense_x(MICRO_COUNTS[:4], False) @ W.T)[:, :K - 1], np.zeros((4, 1))])
    want = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    got = run.probabilities(other).orderBy("doc_id").collect()
    assert np.allclose([[r[f"p_{j}"] for j in range(1, K + 1)] for r in got], want, rtol=1e-10)


def test_training_writes_no_cells_by_document_and_sends_no_weights(spark, monkeypatch):
    """A run neither writes the document-major table nor joins W to cells."""
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, False)
    monkeypatch.setattr(L, "bucketed_table", lambda *a: (_ for _ in ()).throw(AssertionError("cells written again")))
    monkeypatch.setattr(L, "_scores", lambda *a: (_ for _ in ()).throw(AssertionError("W joined to cells")))
    res = L.train(feats, feats, K, L.Schedule(2, check_every=1), 0.001, 0.01)
    assert [h[0] for h in res.history] == [1, 2]


def test_start_weights_shrink_and_score(spark):
    corpus = string_terms(cell_corpus(spark, MICRO_COUNTS, MICRO_CLASSES))
    feats = L.build_features(corpus, False)
    W0 = L.init_weights(feats, K, random_initial=True)
    a = L.train(feats, None, K, L.Schedule(2), 0.01, 0.05, W=W0).W
    b = W0
    for _ in range(2):
        b = L.gradient_step(b, feats, K, 0.01, 0.05)
    assert np.allclose(w_dense(a, 5, feats), w_dense(b, 5, feats), rtol=1e-9, atol=1e-14)


def test_repeated_documents_and_cells_in_one_block(spark):
    """A document listed twice has two bias cells, as in the document-major table."""
    from bowline.sources.corpus import ClassSet, corpus_from_table
    rows = [(1, "a b b", "x"), (1, "b c", "y"), (2, "c a", "y"), (3, "d", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    feats = L.build_features(corpus_from_table(df, ClassSet(("x", "y")), "label"), False)
    got = {r["tkey"]: (r["w_1"], r["w_2"]) for r in L.run_steps(feats, 2, 2, 0.1, 0.01).weights().collect()}
    W = L.init_weights(feats, 2)
    for _ in range(2):
        W = L.gradient_step(W, feats, 2, 0.1, 0.01)
    want = {r["tkey"]: (r["w_1"], r["w_2"]) for r in W.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[t], want[t]) for t in want)


def test_slots_fill_every_partition(spark):
    from pyspark.sql import functions as F
    labels = TB.slots(spark, 7)
    ids = spark.range(1).select(F.explode(F.array(*[F.lit(v).cast("bigint") for v in labels])).alias("tb")).repartition(7, "tb")
    assert sorted(r["p"] for r in ids.select(F.spark_partition_id().alias("p")).collect()) == list(range(7))


def test_texts_are_counted_without_a_shuffle_and_other_splits_without_a_join(spark, monkeypatch):
    """Cells of texts are written as they come; a held split is keyed by hash and
    normalised in its blocks, so neither terms nor column sums are broadcast."""
    from bowline.sources.corpus import ClassSet, corpus_from_table
    rows = [(1, "a b b", "x"), (1, "b c", "y"), (2, "c a", "y"), (3, "d", "x"), (4, "", "x")]
    make = lambda rs: corpus_from_table(spark.createDataFrame(rs, "doc_id long, text string, label string"),
                                        ClassSet(("x", "y")), "label")
    plans, write = {}, L.written_table

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)
    monkeypatch.setattr(L, "written_table", noted)
    feats = L.build_features(make(rows), True)
    assert "Exchange" not in plans["tf"]
    held = L.build_features(make([(7, "b b z", "x"), (8, "a b", "y")]), True, dictionary=feats)
    assert held.block_cells[1] and "Join" not in held.block_cells[0]._jdf.queryExecution().executedPlan().toString()
    run = L.run_steps(feats, 2, 2, 5.0, 0.01, (held,))
    got = {r["doc_id"]: r["p_1"] for r in run.probabilities(held).collect()}
    W = run.kept()
    want = {r["doc_id"]: r["p_1"] for r in L.probabilities(W, held, 2, w_rows=feats.n_terms).collect()}
    assert got.keys() == want.keys() and all(np.isclose(got[d], want[d], rtol=1e-12) for d in want)
    assert feats.cells_with_terms().where("doc_id = 1 and term = 'b' and class_id = 1").count() == 1


def test_a_term_with_the_key_of_another_is_joined(spark):
    from types import SimpleNamespace
    from pyspark.sql import functions as F
    tf = spark.createDataFrame([("b",), ("z",)], "term string")
    terms = lambda named: spark.createDataFrame([("b", named)], "h string, term string").select(
        F.xxhash64("h").alias("tkey"), "term")
    assert L._hashes_apart(tf, SimpleNamespace(bias_key=1, terms=terms("b")))
    assert not L._hashes_apart(tf, SimpleNamespace(bias_key=1, terms=terms("other")))
    assert not L._hashes_apart(tf, SimpleNamespace(bias_key="", terms=terms("b")))


def _many(spark, docs=60, words=40):
    """A text corpus of two classes with a few hundred cells, and one of other texts."""
    from bowline.sources.corpus import ClassSet, corpus_from_table
    text = lambda d, shift: " ".join(f"w{(d * 7 + i * i + shift) % 97}" for i in range(words))
    make = lambda ids, shift: corpus_from_table(
        spark.createDataFrame([(d, text(d, shift), "xy"[d % 2]) for d in ids], "doc_id long, text string, label string"),
        ClassSet(("x", "y")), "label")
    return make(range(docs), 0), make(range(1000, 1000 + docs // 2), 5)


def test_no_row_holds_a_block_and_results_do_not_depend_on_its_size(spark, monkeypatch):
    """Cells and states lie in rows of bounded size, however many a block has."""
    from pyspark.sql import functions as F
    for n, v in dict(CHUNK_CELLS=32, PIECE_CELLS=100, STATE_BYTES=64, GROUPED=2, TERMS_OUT=3).items():
        monkeypatch.setattr(TB, n, v)
    corpus, more = _many(spark)
    feats = L.build_features(corpus, True)
    held = L.build_features(more, True, dictionary=feats)
    run = L.run_steps(feats, 2, 3, 5.0, 0.01, (held,))
    b = run.run.blocks
    size = b.table.where("part >= 0").agg(F.max(F.octet_length("at") / 2).alias("n"), F.count("*").alias("rows")).first()
    cells = feats.n_cells + held.bound
    assert size["n"] <= cells / b.table.select("tb").distinct().count() / 3 and size["rows"] >= cells / (4 * 32)
    assert run.run.state.agg(F.max(F.octet_length("docs"))).first()[0] <= 8 * 24
    W = L.init_weights(feats, 2)
    for _ in range(3):
        W = L.gradient_step(W, feats, 2, 5.0, 0.01)
    want = {r["tkey"]: (r["w_1"], r["w_2"]) for r in W.collect()}
    got = {r["tkey"]: (r["w_1"], r["w_2"]) for r in run.weights().collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[t], want[t], rtol=1e-9, atol=1e-14) for t in want)
    want = {r["doc_id"]: r["p_1"] for r in L.probabilities(W, held, 2, w_rows=feats.n_terms).collect()}
    got = {r["doc_id"]: r["p_1"] for r in run.probabilities(held).collect()}
    assert got.keys() == want.keys() and all(np.isclose(got[d], want[d], rtol=1e-9) for d in want)


def test_a_step_reads_chunks_one_by_one_where_they_lie(spark):
    """No cell is exchanged, a block's rows reach Python as they come, and the
    session's own batch sizes hold again after the step."""
    corpus, _ = _many(spark)
    feats = L.build_features(corpus, False)
    before = {n: spark.conf.get(n, None) for n in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")}
    run = L.run_steps(feats, 2, 1, 0.01, 0.01)
    assert before == {n: spark.conf.get(n, None) for n in before}
    b = run.run.blocks
    plan = b._meet(b.to_blocks(run.run.state), TB._scores_of(2, b.normalize), "part int, dc bigint, docs binary, z binary, tb bigint")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and "Bucketed: true" in plan
    assert "FlatMapGroupsInArrow" in plan and "CoGroup" not in plan


def test_counts_keep_their_values_in_few_bytes():
    for x, size in (([1, 2, 255], 1), ([0, 256], 2), ([70000, 1], 8), ([0.5, 1], 8), ([-1, 2], 8), ([], 8)):
        x = np.array(x, float)
        raw = TB._narrow(x).tobytes()
        assert len(raw) == size * len(x) and TB._wide(raw, len(x)).tolist() == x.tolist()

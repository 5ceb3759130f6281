"""Registered queries for the readers and sinks: each writes data that Spark
derives from the driver tables into the shared checkpoint folder, reads it back
with the matching reader, and returns what was read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.operators import evaluate as E
from bowline.operators import logistic as L
from bowline.operators import naive_bayes as NB
from bowline.operators import ranking as R
from bowline.plans import lr_queries as LQ
from bowline.plans import nb_queries as NQ
from bowline.plans import sql as S
from bowline.plans.workload import LR_LABEL, LR_NORMALISED, LR_PLAIN, LR_STEPS, Workload
from bowline.session import work_path
from bowline.sources import matrix as M
from bowline.sources import models as MD
from bowline.sources import tables as T
from bowline.sources.corpus import ClassSet, term_counts


def _run_dir(spark, name: str) -> str:
    return work_path(spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")


def q_scan_vocabulary(spark, sf_dir) -> DataFrame:
    """Write the corpus vocabulary (sorted, one term per line), read it back
    with line numbers as term ids."""
    w = Workload.of(spark, sf_dir)
    path = _run_dir(spark, "vocabulary")
    w.corpus(None).vocabulary().orderBy("term").write.text(path)
    return M.read_vocabulary(spark, path)


def q_scan_class_labels(spark, sf_dir) -> DataFrame:
    w = Workload.of(spark, sf_dir)
    path = _run_dir(spark, "labels")
    classes = w.classes(NQ.EVAL_LABEL).to_df(spark)
    T.write_lines(classes.select(F.concat_ws(" ", F.col("class_id").cast("string"), "name").alias("value")), path)
    return M.read_class_labels(spark, path)


def q_beta_accuracy_curve(spark, sf_dir) -> DataFrame:
    path = _run_dir(spark, "acc")
    acc = NQ.sweep_accuracy(spark, sf_dir)
    acc.write.option("header", True).csv(path)
    return M.read_metrics(spark, path).select("beta", F.round("accuracy", 9).alias("accuracy"))


def q_load_or_build(spark, sf_dir) -> DataFrame:
    docs = Workload.of(spark, sf_dir).table("documents")
    return T.load_or_build(spark, "term_counts", lambda: term_counts(docs), "term_counts", source=docs)


def q_write_predictions(spark, sf_dir) -> DataFrame:
    path = _run_dir(spark, "predictions")
    preds = NQ.q_nb_predict(spark, sf_dir)
    T.write_predictions(preds, path, id_col="id", class_col="predicted")
    return T.read_predictions(spark, path)


def _matrix_files(spark, sf_dir) -> tuple[str, str, str]:
    """(matrix, vocabulary, labels): the text files a classifier starts from, for
    all labelled documents over the whole vocabulary, in sparse rows."""
    w = Workload.of(spark, sf_dir)
    matrix, words, labels = (_run_dir(spark, n) for n in ("matrix", "matrix-words", "matrix-labels"))
    w.corpus(None).vocabulary().orderBy("term").write.text(words)
    M.write_sparse_matrix(w.corpus(NQ.EVAL_LABEL).labelled(), M.read_vocabulary(spark, words), matrix)
    classes = w.classes(NQ.EVAL_LABEL).to_df(spark)
    T.write_lines(classes.select(F.concat_ws(" ", F.col("class_id").cast("string"), "name").alias("value")), labels)
    return matrix, words, labels


def q_scan_count_matrix(spark, sf_dir) -> DataFrame:
    """Write the count matrix, read it back: its nonzero cells, with words."""
    matrix, words, _ = _matrix_files(spark, sf_dir)
    return R.with_words(M.read_sparse_matrix(spark, matrix).cells(), M.read_vocabulary(spark, words))


def q_matrix_word_ranking(spark, sf_dir) -> DataFrame:
    """Naive Bayes fitted on the count matrix as read, ranked by word."""
    matrix, words, labels = _matrix_files(spark, sf_dir)
    classes = ClassSet.from_df(M.read_class_labels(spark, labels))
    vocabulary = M.read_vocabulary(spark, words)
    model = NB.nb_fit(M.read_sparse_matrix(spark, matrix), classes, vocab_size=vocabulary.count())
    ranking = R.word_ranking(model, num_words=100, words=vocabulary)
    return ranking.select("rank", "term", F.round("score", 9).alias("score"))


def q_scan_matrix_rejects(spark, sf_dir) -> DataFrame:
    """The count matrix with rows spoilt by a rule on their ids, read tolerantly:
    rows by reason (null: read), and the tokens that were read."""
    matrix, _, _ = _matrix_files(spark, sf_dir)
    last, doc = F.concat(F.col("value"), F.lit(" 5:many")), F.split("value", " ")[0].cast("bigint")
    parts = F.split("value", " ", 3)
    spoilt = (F.when(doc % 10 == 1, last).when(doc % 10 == 3, F.concat_ws(" ", parts[0], F.lit("x"), F.get(parts, F.lit(2))))
              .when(doc % 10 == 5, parts[0]).when(doc % 10 == 7, F.concat(F.lit("no."), F.col("value")))
              .otherwise(F.col("value")))
    path = _run_dir(spark, "matrix-spoilt")
    T.write_lines(spark.read.text(matrix).select(spoilt.alias("value")), path)
    scan = M.scan_sparse_matrix(spark, path)
    tokens = scan.corpus.cells().agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"))
    return scan.counts().select(F.coalesce("reason", F.lit("read")).alias("reason"), "n").unionByName(
        tokens.select(F.lit("tokens").alias("reason"), "n"))


def q_score_from_bundle(spark, sf_dir) -> DataFrame:
    """Train, commit the model, and score the benchmark items from the committed
    bundle alone: class ids and names."""
    w = Workload.of(spark, sf_dir)
    root = _run_dir(spark, "bundles")
    MD.ModelStore(spark, root).save(w.lr_weights(LR_NORMALISED, LR_STEPS), w.features("train", True), w.classes(LR_LABEL),
                                    LR_STEPS, LR_NORMALISED["eta"], LR_NORMALISED["lam"], True)
    bundle = MD.ModelStore(spark, root).load()
    return bundle.predict(w.benchmark()).select(F.col("doc_id").alias("id"), "predicted", "predicted_name")


def q_named_predictions(spark, sf_dir) -> DataFrame:
    w = Workload.of(spark, sf_dir)
    preds = NQ.q_nb_predict(spark, sf_dir)
    return E.with_class_names(preds, w.classes(NQ.FIT_LABEL).to_df(spark), ["predicted"])


def q_named_confusion_matrix(spark, sf_dir) -> DataFrame:
    w = Workload.of(spark, sf_dir)
    cm = NQ.q_confusion_matrix_nb(spark, sf_dir)
    return E.with_class_names(cm, w.classes(NQ.EVAL_LABEL).to_df(spark), ["predicted", "actual"]).select(
        "predicted_name", "actual_name", "n")


def q_confusion_matrix_train(spark, sf_dir) -> DataFrame:
    """The confusion matrix of the training split, kept as a table."""
    w = Workload.of(spark, sf_dir)
    preds = L.predicted(w.lr_probabilities(LR_PLAIN, LR_STEPS, "train"), w.k_lr)
    return T.written_table(E.confusion_matrix(preds, w.classes(LR_LABEL)), "confusion")


def q_split_tables(spark, sf_dir) -> DataFrame:
    """Both parts of the split written as one table partitioned by part."""
    w = Workload.of(spark, sf_dir)
    path = _run_dir(spark, "split")
    docs = w.table("documents")
    docs.withColumn("split", w.split().label()).where("split IS NOT NULL").write.partitionBy("split").parquet(path)
    return spark.read.parquet(path).select("doc_id", "lang", F.length("text").cast("bigint").alias("n_chars"), "split")


def q_ranked_words_text(spark, sf_dir) -> DataFrame:
    """The ranking as numbered text lines, read back."""
    path = _run_dir(spark, "ranked")
    T.write_lines(R.format_ranking(NQ.q_word_ranking(spark, sf_dir)), path)
    return R.parse_ranking(spark.read.text(path))


def q_lr_write_predictions(spark, sf_dir) -> DataFrame:
    """Score the validation split with a chosen snapshot (not the latest) and
    write it with its run parameters; what the files say."""
    w = Workload.of(spark, sf_dir)
    store = _fresh_store(spark)
    eta, lam = LR_PLAIN["eta"], LR_PLAIN["lam"]
    L.train(w.features("train", False), None, w.k_lr, L.Schedule(LR_STEPS, save_every=LR_STEPS - 1), eta, lam,
            snapshots=store)
    W, done = store.load(LR_STEPS - 1)
    path = _run_dir(spark, "lr-predictions")
    L.write_split_predictions(W, w.features("validation", False), w.k_lr, path, eta, lam, done)
    return T.read_predictions(spark, path).select(
        "id", "class", F.col("eta").cast("double").alias("eta"), F.col("lambda").cast("double").alias("lambda"),
        F.col("iter").cast("int").alias("iter"))


def _fresh_store(spark) -> T.SnapshotStore:
    return T.SnapshotStore(spark, _run_dir(spark, "snapshots"))


def q_resume_training(spark, sf_dir) -> DataFrame:
    """Train two steps, then resume from the latest snapshot in the store for
    what is missing to LR_STEPS: the weights of a straight run."""
    w = Workload.of(spark, sf_dir)
    feats, store = w.features("train", True), _fresh_store(spark)
    step = (LR_NORMALISED["eta"], LR_NORMALISED["lam"])
    L.train(feats, None, w.k_lr, L.Schedule(2), *step, snapshots=store)
    W, done = T.SnapshotStore(spark, store.root).load()
    res = L.train(feats, None, w.k_lr, L.Schedule(LR_STEPS - done), *step, W=W, snapshots=store, start_iter=done)
    return LQ._weights_out(w, res.W)


def q_model_snapshots(spark, sf_dir) -> DataFrame:
    """Train 3 normalised steps saving every 2: snapshots 2 and 3 (remainder)."""
    w = Workload.of(spark, sf_dir)
    store = _fresh_store(spark)
    feats = w.features("train", True)
    L.train(feats, None, w.k_lr, L.Schedule(3, save_every=2), LR_NORMALISED["eta"], LR_NORMALISED["lam"],
            snapshots=store)
    k = w.k_lr
    t = L.with_terms(store.table(), feats)
    cells = F.array(*[F.struct(F.lit(j).alias("class_id"), F.col(f"w_{j}").alias("w")) for j in range(1, k + 1)])
    return t.select(F.col("iter").cast("int").alias("iter"), "term", F.inline(cells)).select(
        "iter", "term", "class_id", F.round("w", LQ.WD).alias("w"))


QUERIES = {
    "scan_vocabulary": q_scan_vocabulary,
    "scan_class_labels": q_scan_class_labels,
    "beta_accuracy_curve": q_beta_accuracy_curve,
    "load_or_build": q_load_or_build,
    "write_predictions": q_write_predictions,
    "model_snapshots": q_model_snapshots,
    "resume_training": q_resume_training,
    "scan_count_matrix": q_scan_count_matrix,
    "matrix_word_ranking": q_matrix_word_ranking,
    "scan_matrix_rejects": q_scan_matrix_rejects,
    "score_from_bundle": q_score_from_bundle,
    "named_predictions": q_named_predictions,
    "named_confusion_matrix": q_named_confusion_matrix,
    "confusion_matrix_train": q_confusion_matrix_train,
    "split_tables": q_split_tables,
    "ranked_words_text": q_ranked_words_text,
    "lr_write_predictions": q_lr_write_predictions,
}


def _oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    o["scan_vocabulary"] = S.with_(
        [S.toks()], "SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id, term "
                    "FROM (SELECT DISTINCT term FROM toks)")
    o["scan_class_labels"] = S.with_([S.classes(NQ.EVAL_LABEL)], "SELECT class_id, name FROM cls")
    o["beta_accuracy_curve"] = S.with_(NQ._sweep_ctes(), "SELECT beta, round(accuracy, 9) AS accuracy FROM bacc")
    o["load_or_build"] = NQ.ORACLE["term_counts"]
    o["write_predictions"] = NQ.ORACLE["nb_predict"].replace(
        "SELECT doc_id AS id, predicted FROM pred", 'SELECT CAST(doc_id AS BIGINT) AS id, CAST(predicted AS INTEGER) AS "class" FROM pred')
    o["resume_training"] = LQ.ORACLE["lr_train"]
    snap = LQ._base(True) + LQ._steps(3, LR_NORMALISED["eta"], LR_NORMALISED["lam"])
    o["model_snapshots"] = S.with_(
        snap, f"SELECT 2 AS iter, term, class_id, round(w, {LQ.WD}) AS w FROM w2 UNION ALL "
              f"SELECT 3 AS iter, term, class_id, round(w, {LQ.WD}) AS w FROM w3")
    o["scan_count_matrix"] = NQ.ORACLE["words_per_class"].replace(
        "SELECT d.class_id, t.term, count(*) AS cnt", "SELECT d.doc_id, d.class_id, t.term, count(*) AS cnt").replace(
        "GROUP BY d.class_id, t.term", "GROUP BY d.doc_id, d.class_id, t.term")
    ranking = NQ.ORACLE["word_ranking"]
    o["matrix_word_ranking"] = ranking
    o["scan_matrix_rejects"] = S.with_(
        [S.toks(), S.classes(NQ.EVAL_LABEL), S.docs(NQ.EVAL_LABEL),
         "why AS (SELECT doc_id, CASE doc_id % 10 WHEN 1 THEN 'count' WHEN 3 THEN 'class' WHEN 5 THEN 'fields' "
         "WHEN 7 THEN 'id' ELSE 'read' END AS reason FROM docs WHERE class_id IS NOT NULL)"],
        "SELECT reason, count(*) AS n FROM why GROUP BY reason UNION ALL SELECT 'tokens', count(*) FROM toks "
        "JOIN why USING (doc_id) WHERE reason = 'read'")
    o["score_from_bundle"] = LQ.ORACLE["lr_predict_raw"].replace(
        "SELECT doc_id AS id, predicted FROM pr_raw", "SELECT p.doc_id AS id, p.predicted, c.name AS predicted_name "
        "FROM pr_raw p LEFT JOIN cls c ON c.class_id = p.predicted")
    o["named_predictions"] = NQ.ORACLE["nb_predict"].replace(
        "SELECT doc_id AS id, predicted FROM pred",
        "SELECT p.doc_id AS id, p.predicted, c.name AS predicted_name FROM pred p LEFT JOIN cls c ON c.class_id = p.predicted")
    o["named_confusion_matrix"] = S.with_(
        NQ._eval_pred_ctes(),
        "SELECT a.name AS predicted_name, b.name AS actual_name, CAST(count(p.doc_id) AS BIGINT) AS n "
        "FROM cls a CROSS JOIN cls b LEFT JOIN pred p ON p.predicted = a.class_id AND p.class_id = b.class_id "
        "GROUP BY a.name, b.name")
    o["split_tables"] = S.with_(
        [S.split()], "SELECT d.doc_id, d.lang, length(d.text) AS n_chars, s.split FROM documents d JOIN split s USING (doc_id)")
    o["ranked_words_text"] = ranking
    plain = LQ._base(False, [("va", LQ._VA, False, "toks")]) + LQ._steps(LR_STEPS, LR_PLAIN["eta"], LR_PLAIN["lam"])
    o["confusion_matrix_train"] = S.with_(
        plain + LQ._probs("pt", f"w{LR_STEPS}", "tr") + [LQ._pred("pt")],
        "SELECT a.class_id AS predicted, b.class_id AS actual, CAST(count(p.doc_id) AS BIGINT) AS n "
        "FROM cls a CROSS JOIN cls b LEFT JOIN pr_pt p ON p.predicted = a.class_id AND p.class_id = b.class_id "
        "GROUP BY a.class_id, b.class_id")
    o["lr_write_predictions"] = S.with_(
        plain + LQ._probs("pw", f"w{LR_STEPS - 1}", "va") + [LQ._pred("pw")],
        f'SELECT CAST(doc_id AS BIGINT) AS id, CAST(predicted AS INTEGER) AS "class", {LR_PLAIN["eta"]!r}::DOUBLE AS eta, '
        f'{LR_PLAIN["lam"]!r}::DOUBLE AS "lambda", {LR_STEPS - 1}::INTEGER AS iter FROM pr_pw')
    return o


ORACLE = _oracle()

"""Registered queries for counting, the split, Naive Bayes, evaluation and the
word ranking, each with its DuckDB oracle.

Task mapping onto the driver tables: ``documents`` is the labelled training
file (classes = ``lang`` or ``source``), split head/tail 80/20 by doc_id;
``benchmark`` is the unlabelled scoring file. ``source`` (20 classes, unrelated
to the text) drives the evaluation keys so that errors and ties are exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.operators import class_blocks as CB
from bowline.operators import counts as C
from bowline.operators import evaluate as E
from bowline.operators import naive_bayes as NB
from bowline.operators import ranking as R
from bowline.plans import sql as S
from bowline.plans.workload import Workload
from bowline.sources.corpus import ClassSet, corpus_from_table, term_counts

EVAL_LABEL = "source"
FIT_LABEL = "lang"


def _w(spark: SparkSession, sf_dir: str) -> Workload:
    return Workload.of(spark, sf_dir)


# --- S0 / A1-A6 / P9 / P5 / P7 ---------------------------------------------

def q_term_counts(spark, sf_dir) -> DataFrame:
    return term_counts(_w(spark, sf_dir).table("documents"))


def q_words_per_class(spark, sf_dir) -> DataFrame:
    return C.words_per_class_long(_w(spark, sf_dir).corpus(EVAL_LABEL))


def q_docs_per_class(spark, sf_dir) -> DataFrame:
    return C.docs_per_class(_w(spark, sf_dir).corpus(EVAL_LABEL))


def q_total_words_per_class(spark, sf_dir) -> DataFrame:
    return C.class_totals(_w(spark, sf_dir).corpus(EVAL_LABEL)).select("class_id", "n_words")


def q_word_totals(spark, sf_dir) -> DataFrame:
    return C.word_totals(_w(spark, sf_dir).corpus(None))


def q_document_lengths(spark, sf_dir) -> DataFrame:
    return C.document_lengths(_w(spark, sf_dir).corpus(None))


def q_word_frequency_outliers(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    model = w.nb_model(EVAL_LABEL, part="all")
    bounds = C.frequency_outlier_bounds(model.counts, model.k, model.vocab_size, model.stats)
    return C.word_frequency_outliers(model.counts, model.k, bounds)


def q_train_validation_split(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    return w.table("documents").select("doc_id", w.split().label().alias("split"))


def q_one_hot_labels(spark, sf_dir) -> DataFrame:
    """Sparse delta matrix of the training split: (class_id, doc_id, value=1)."""
    w = _w(spark, sf_dir)
    return (w.train(FIT_LABEL).labelled().rows()
             .select("class_id", "doc_id", F.lit(1).alias("value")))


# --- Naive Bayes -------------------------------------------------------------

def q_nb_fit(spark, sf_dir) -> DataFrame:
    """Dense k x V log2 likelihoods (+ log prior) fitted on the training split."""
    w = _w(spark, sf_dir)
    model = w.nb_model(FIT_LABEL, part="train")
    return model.log_likelihood_long().select(
        "class_id", "term", F.round("log_likelihood", 9).alias("log_likelihood"),
        F.round("log_prior", 9).alias("log_prior"))


def q_nb_classify(spark, sf_dir) -> DataFrame:
    """All k scores of every validation document."""
    w = _w(spark, sf_dir)
    model = w.nb_model(FIT_LABEL, part="train")
    scores = NB.nb_scores(model, w.validation(FIT_LABEL))
    return NB.scores_long(scores, model.k).select("doc_id", "score_class", F.round("score", 6).alias("score"))


def q_nb_predict(spark, sf_dir) -> DataFrame:
    """Fit on all documents (beta = 1/V), classify the benchmark items: (id, predicted)."""
    w = _w(spark, sf_dir)
    model = w.nb_model(FIT_LABEL, part="all", with_benchmark=True)
    return NB.nb_predict(model, w.benchmark()).select(F.col("doc_id").alias("id"), "predicted")


def _eval_preds(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    model = w.nb_model(EVAL_LABEL, part="train")
    return NB.nb_predict(model, w.validation(EVAL_LABEL))


def q_nb_beta_sweep(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    model = w.nb_model(EVAL_LABEL, part="train")
    return NB.nb_beta_sweep(model, w.validation(EVAL_LABEL)).select("beta", "doc_id", "predicted")


def sweep_accuracy(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    model = w.nb_model(EVAL_LABEL, part="train")
    sweep = NB.nb_beta_sweep(model, w.validation(EVAL_LABEL))
    return E.accuracy(sweep, by=["beta"]).select("beta", "accuracy")


def q_best_beta(spark, sf_dir) -> DataFrame:
    acc = sweep_accuracy(spark, sf_dir)
    return E.best_by_accuracy(acc, "beta").select("beta", F.round("accuracy", 9).alias("accuracy"))


def q_accuracy(spark, sf_dir) -> DataFrame:
    return E.accuracy(_eval_preds(spark, sf_dir)).select(F.round("accuracy", 9).alias("accuracy"), "n")


def q_confusion_matrix_nb(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    return E.confusion_matrix(_eval_preds(spark, sf_dir), w.classes(EVAL_LABEL))


def q_prediction_counts(spark, sf_dir) -> DataFrame:
    return E.prediction_counts(_eval_preds(spark, sf_dir))


def q_word_ranking(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    model = w.nb_model(EVAL_LABEL, part="all")
    ranking = R.word_ranking(model, None, 100)
    return ranking.select("rank", "term", F.round("score", 9).alias("score"))


def q_words_per_class_blocks(spark, sf_dir) -> DataFrame:
    """The counts by class, taken in blocks of eight classes."""
    w = _w(spark, sf_dir)
    model = CB.fit_class_blocks(w.corpus(EVAL_LABEL), w.classes(EVAL_LABEL), block=8)
    return model.log_likelihood_long().select("class_id", "term", F.round("log_likelihood", 9).alias("log_likelihood"))


def _pair_corpus(w: Workload):
    """The documents by source and language together: a few dozen classes."""
    docs = w.table("documents").withColumn("pair", F.concat("source", F.lit("/"), "lang"))
    classes = ClassSet.from_labels(docs, "pair")
    return corpus_from_table(docs, classes, "pair"), classes


def q_nb_predict_class_blocks(spark, sf_dir) -> DataFrame:
    """Hold-out predictions over all (source, lang) classes, in blocks."""
    w = _w(spark, sf_dir)
    corpus, classes = _pair_corpus(w)
    model = CB.fit_class_blocks(corpus.where(w.split().train()), classes, 32, [w.validation(FIT_LABEL)])
    return CB.predict_class_blocks(model, corpus.where(w.split().validation())).select("doc_id", "predicted")


QUERIES = {
    "words_per_class_blocks": q_words_per_class_blocks,
    "nb_predict_class_blocks": q_nb_predict_class_blocks,
    "term_counts": q_term_counts,
    "words_per_class": q_words_per_class,
    "docs_per_class": q_docs_per_class,
    "total_words_per_class": q_total_words_per_class,
    "word_totals": q_word_totals,
    "document_lengths": q_document_lengths,
    "word_frequency_outliers": q_word_frequency_outliers,
    "train_validation_split": q_train_validation_split,
    "one_hot_labels": q_one_hot_labels,
    "nb_fit": q_nb_fit,
    "nb_classify": q_nb_classify,
    "nb_predict": q_nb_predict,
    "nb_beta_sweep": q_nb_beta_sweep,
    "best_beta": q_best_beta,
    "accuracy": q_accuracy,
    "confusion_matrix_nb": q_confusion_matrix_nb,
    "prediction_counts": q_prediction_counts,
    "word_ranking": q_word_ranking,
}


# --- oracle SQL ----------------------------------------------------------------

def _base(label: str) -> list[str]:
    return [S.toks(), S.classes(label), S.split(), S.docs(label)]


_TRAIN = "doc_id IN (SELECT doc_id FROM split WHERE split = 'train')"
_VAL_DOCS = "vdocs AS (SELECT doc_id, class_id FROM docs WHERE doc_id IN (SELECT doc_id FROM split WHERE split = 'validation'))"
_BETAS = "(VALUES " + ", ".join(f"({b!r}::DOUBLE)" for b in NB.BETA_GRID) + ") bt(beta)"


def _sweep_ctes() -> list[str]:
    return _base(EVAL_LABEL) + S.nb_model(_TRAIN) + [
        _VAL_DOCS,
        "ttok AS (SELECT t.doc_id, t.term FROM toks t JOIN vdocs d USING (doc_id))",
        "cst AS (SELECT c.class_id, c.n_docs, c.n_words, p.lp FROM cstat c JOIN prior p USING (class_id))",
        f"bts AS (SELECT beta FROM {_BETAS})",
        "tsum AS (SELECT b.beta, t.doc_id, c.class_id, sum(log2((coalesce(w.c, 0) + b.beta) / "
        "(c.n_words + b.beta * (SELECT v FROM vv)))) AS a FROM ttok t CROSS JOIN bts b CROSS JOIN cst c "
        "LEFT JOIN wc w ON w.term = t.term AND w.class_id = c.class_id GROUP BY b.beta, t.doc_id, c.class_id)",
        "bsc AS (SELECT b.beta, d.doc_id, d.class_id, c.class_id AS score_class, coalesce(s.a, 0) + c.lp AS score "
        "FROM vdocs d CROSS JOIN bts b CROSS JOIN cst c LEFT JOIN tsum s ON s.beta = b.beta AND s.doc_id = d.doc_id "
        "AND s.class_id = c.class_id)",
        "bpred AS (SELECT beta, doc_id, class_id, score_class AS predicted FROM (SELECT *, row_number() OVER "
        "(PARTITION BY beta, doc_id ORDER BY score DESC, score_class) AS rk FROM bsc) WHERE rk = 1)",
        "bacc AS (SELECT beta, avg(CASE WHEN predicted = class_id THEN 1.0 ELSE 0.0 END) AS accuracy "
        "FROM bpred WHERE class_id IS NOT NULL GROUP BY beta)",
    ]


def _eval_pred_ctes() -> list[str]:
    return _base(EVAL_LABEL) + S.nb_model(_TRAIN) + [_VAL_DOCS] + S.nb_scores("vdocs", "toks")


def _ranking_ctes() -> list[str]:
    return _base(EVAL_LABEL) + S.nb_model("TRUE") + [
        "vocab AS (SELECT DISTINCT term FROM toks)",
        "tot AS (SELECT term, sum(c) AS total FROM wc GROUP BY term)",
        "avgw AS (SELECT (SELECT sum(n_words) FROM cstat)::DOUBLE / (SELECT v FROM vv) AS a)",
        "sdw AS (SELECT sqrt((coalesce((SELECT sum(pow(total - (SELECT a FROM avgw), 2)) FROM tot), 0) "
        "+ ((SELECT v FROM vv) - (SELECT count(*) FROM tot)) * pow((SELECT a FROM avgw), 2) "
        "+ pow((SELECT n FROM nn) - (SELECT a FROM avgw), 2)) / (SELECT v FROM vv)) AS sd)",
        "kept AS (SELECT term, total, (total >= (SELECT a FROM avgw) - 2 * (SELECT sd FROM sdw) AND "
        "total <= (SELECT a FROM avgw) + 2 * (SELECT sd FROM sdw)) AS kept FROM tot)",
    ]


def _oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    o["term_counts"] = S.with_([S.toks()], "SELECT doc_id, term, count(*) AS cnt FROM toks GROUP BY doc_id, term")
    lab = _base(EVAL_LABEL)
    o["words_per_class"] = S.with_(lab, "SELECT d.class_id, t.term, count(*) AS cnt FROM toks t JOIN docs d "
                                        "USING (doc_id) WHERE d.class_id IS NOT NULL GROUP BY d.class_id, t.term")
    o["docs_per_class"] = S.with_(lab, "SELECT class_id, count(*) AS n_docs FROM docs WHERE class_id IS NOT NULL "
                                       "GROUP BY class_id")
    o["total_words_per_class"] = S.with_(
        lab, "SELECT d.class_id, coalesce(sum(x.n), 0) AS n_words FROM docs d LEFT JOIN "
             "(SELECT doc_id, count(*) AS n FROM toks GROUP BY doc_id) x USING (doc_id) "
             "WHERE d.class_id IS NOT NULL GROUP BY d.class_id")
    o["word_totals"] = S.with_([S.toks()], "SELECT term, count(*) AS total FROM toks GROUP BY term")
    o["document_lengths"] = S.with_(
        [S.toks()], "SELECT d.doc_id, coalesce(t.n, 0) AS n_tokens FROM documents d LEFT JOIN "
                    "(SELECT doc_id, count(*) AS n FROM toks GROUP BY doc_id) t USING (doc_id)")
    o["word_frequency_outliers"] = S.with_(_ranking_ctes(), "SELECT term, total, kept FROM kept")
    o["train_validation_split"] = S.with_([S.split()], "SELECT doc_id, split FROM split")
    o["one_hot_labels"] = S.with_(
        _base(FIT_LABEL), "SELECT class_id, doc_id, 1 AS value FROM docs WHERE class_id IS NOT NULL AND "
                          + _TRAIN)
    fit = _base(FIT_LABEL) + S.nb_model(_TRAIN)
    o["nb_fit"] = S.with_(
        fit + ["vocab AS (SELECT DISTINCT term FROM toks)"],
        "SELECT p.class_id, v.term, round(log2((coalesce(w.c, 0) + (SELECT beta FROM bb)) / p.den), 9) "
        "AS log_likelihood, round(p.lp, 9) AS log_prior FROM vocab v CROSS JOIN prior p "
        "LEFT JOIN wc w ON w.term = v.term AND w.class_id = p.class_id")
    o["nb_classify"] = S.with_(
        fit + [_VAL_DOCS] + S.nb_scores("vdocs", "toks"),
        "SELECT doc_id, score_class, round(score, 6) AS score FROM sc")
    pred_all = ([S.toks(), S.toks("btoks", "benchmark", "item_id"),
                 S.classes(FIT_LABEL), S.split(), S.docs(FIT_LABEL)]
                + S.nb_model("TRUE", vocab_from="(SELECT term FROM toks UNION ALL SELECT term FROM btoks)")
                + ["bdocs AS (SELECT item_id AS doc_id, CAST(NULL AS INTEGER) AS class_id FROM benchmark)"]
                + S.nb_scores("bdocs", "btoks"))
    o["nb_predict"] = S.with_(pred_all, "SELECT doc_id AS id, predicted FROM pred")
    o["nb_beta_sweep"] = S.with_(_sweep_ctes(), "SELECT beta, doc_id, predicted FROM bpred")
    o["best_beta"] = S.with_(_sweep_ctes(), "SELECT beta, round(accuracy, 9) AS accuracy FROM bacc "
                                            "ORDER BY accuracy DESC, beta LIMIT 1")
    ev = _eval_pred_ctes()
    o["accuracy"] = S.with_(ev, "SELECT round(avg(CASE WHEN predicted = class_id THEN 1.0 ELSE 0.0 END), 9) "
                                "AS accuracy, count(*) AS n FROM pred WHERE class_id IS NOT NULL")
    o["confusion_matrix_nb"] = S.with_(
        ev, "SELECT a.class_id AS predicted, b.class_id AS actual, CAST(count(p.doc_id) AS BIGINT) AS n "
            "FROM cls a CROSS JOIN cls b LEFT JOIN pred p ON p.predicted = a.class_id AND p.class_id = b.class_id "
            "GROUP BY a.class_id, b.class_id")
    pair = "(source || '/' || lang)"
    o["nb_predict_class_blocks"] = S.with_(
        _base(pair) + S.nb_model(_TRAIN) + [_VAL_DOCS] + S.nb_scores("vdocs", "toks"), "SELECT doc_id, predicted FROM pred")
    o["words_per_class_blocks"] = S.with_(
        _base(EVAL_LABEL) + S.nb_model("TRUE"),
        "SELECT w.class_id, w.term, round(log2((w.c + (SELECT beta FROM bb)) / p.den), 9) AS log_likelihood "
        "FROM wc w JOIN prior p USING (class_id)")
    o["prediction_counts"] = S.with_(ev, "SELECT predicted, count(*) AS n FROM pred GROUP BY predicted")
    o["word_ranking"] = S.with_(
        _ranking_ctes() + [
            "cells AS (SELECT v.term, c.class_id, CASE WHEN coalesce(k.kept, (0 >= (SELECT a FROM avgw) - 2 * "
            "(SELECT sd FROM sdw) AND 0 <= (SELECT a FROM avgw) + 2 * (SELECT sd FROM sdw))) THEN coalesce(w.c, 0) "
            "ELSE 0 END AS f, c.n_words FROM vocab v CROSS JOIN cstat c LEFT JOIN kept k ON k.term = v.term "
            "LEFT JOIN wc w ON w.term = v.term AND w.class_id = c.class_id "
            "WHERE c.class_id < (SELECT max(class_id) FROM cls))",
            "ent AS (SELECT term, sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END) AS e FROM (SELECT term, "
            "(f + (SELECT beta FROM bb)) / (n_words + (SELECT beta FROM bb)) AS p FROM cells) GROUP BY term)",
        ],
        "SELECT CAST(row_number() OVER (ORDER BY round(e, 9), term) AS INTEGER) AS rank, term, round(-e, 9) AS score "
        "FROM ent ORDER BY round(e, 9), term LIMIT 100")
    return o


ORACLE = _oracle()

"""Registered logistic-regression queries (class = ``lang``) and their oracles.

Two fixed variants: normalised features with the reference defaults
(eta 0.01, lambda 0.005) for the weight keys, and plain counts with a small
step for the prediction keys (three normalised steps barely move W, so argmax
would hang on rounding). The oracle unrolls the gradient steps as CTEs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.operators import evaluate as E
from bowline.operators import logistic as L
from bowline.operators import ranking as R
from bowline.plans import sql as S
from bowline.plans.workload import LR_LABEL, LR_NORMALISED, LR_PLAIN, LR_STEPS, Workload

WD = 12   # decimal places kept for weights
WIDE_LABEL = "source"   # 20 classes
PD = 9    # decimal places kept for probabilities / accuracies


def _w(spark, sf_dir) -> Workload:
    return Workload.of(spark, sf_dir)


def _weights_out(w: Workload, W: DataFrame, digits: int = WD) -> DataFrame:
    split = w.features("train", True)
    return L.weights_long(W, w.k_lr, split).select("term", "class_id", F.round("w", digits).alias("w"))


def q_normalize_features(spark, sf_dir) -> DataFrame:
    x = _w(spark, sf_dir).features("train", True).cells_with_terms()
    return x.select("doc_id", "term", F.round("x", WD).alias("x"))


def q_lr_gradient_step(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    return _weights_out(w, w.lr_weights(LR_NORMALISED, 1))


def q_lr_train(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    res = L.train(w.features("train", True), None, w.k_lr, L.Schedule(LR_STEPS),
                  LR_NORMALISED["eta"], LR_NORMALISED["lam"])
    return _weights_out(w, res.W)


def q_normalize_weights(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    return _weights_out(w, L.normalize_weights(w.lr_weights(LR_NORMALISED, 1), w.k_lr), 15)


def q_weight_diagnostics(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    d = L.weight_diagnostics(w.lr_weights(LR_NORMALISED, 1), w.k_lr)
    # abs_sum adds ~k*V terms: keep 6 places so summation order cannot show
    return d.select(F.round("max_w", WD).alias("max_w"), F.round("abs_sum", 6).alias("abs_sum"))


def q_lr_history(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    res = L.train(w.features("train", True), w.features("validation", True), w.k_lr,
                  L.Schedule(LR_STEPS, check_every=1), LR_NORMALISED["eta"], LR_NORMALISED["lam"])
    rows = [(i, round(tr, PD), round(va, PD)) for i, tr, va in res.history]
    return spark.createDataFrame(rows, "iter int, train_accuracy double, validation_accuracy double")


def _plain_probs(spark, sf_dir, part: str) -> DataFrame:
    return _w(spark, sf_dir).lr_probabilities(LR_PLAIN, LR_STEPS, part)


def q_lr_probabilities(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    p = _plain_probs(spark, sf_dir, "validation")
    return L.probabilities_long(p, w.k_lr).select("doc_id", "prob_class", F.round("p", PD).alias("p"))


def _plain_preds(spark, sf_dir) -> DataFrame:
    return L.predicted(_plain_probs(spark, sf_dir, "validation"), _w(spark, sf_dir).k_lr)


def q_lr_predict(spark, sf_dir) -> DataFrame:
    return _plain_preds(spark, sf_dir).select("doc_id", "predicted")


def q_confusion_matrix_lr(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    return E.confusion_matrix(_plain_preds(spark, sf_dir), w.classes(LR_LABEL))


def q_lr_predict_raw(spark, sf_dir) -> DataFrame:
    """W trained on normalised features applied to raw counts (bias 1) of the
    benchmark items, as the reference's single-document prediction does."""
    w = _w(spark, sf_dir)
    p = w.lr_probabilities(LR_NORMALISED, LR_STEPS, "benchmark")
    return L.predicted(p, w.k_lr).select(F.col("doc_id").alias("id"), "predicted")


def q_uncertain_documents(spark, sf_dir) -> DataFrame:
    w = _w(spark, sf_dir)
    p = _plain_probs(spark, sf_dir, "benchmark")
    top = R.uncertain_documents(p, w.k_lr, 100, "gini")
    return top.select("rank", "doc_id", F.round("entropy", PD).alias("entropy"), F.round("gini", PD).alias("gini"))


def _source_probs(spark, sf_dir) -> tuple[DataFrame, int]:
    """Probabilities of the validation documents for the 20 ``source`` classes."""
    w = _w(spark, sf_dir)
    return w.lr_probabilities(LR_PLAIN, LR_STEPS, "validation", WIDE_LABEL), w.classes(WIDE_LABEL).k


def q_lr_probabilities_source(spark, sf_dir) -> DataFrame:
    p, k = _source_probs(spark, sf_dir)
    return L.probabilities_long(p, k).select("doc_id", "prob_class", F.round("p", PD).alias("p"))


def q_uncertain_validation_documents(spark, sf_dir) -> DataFrame:
    p, k = _source_probs(spark, sf_dir)
    top = R.uncertain_documents(p, k, 100, "entropy")
    return top.select("rank", "doc_id", F.round("entropy", PD).alias("entropy"), F.round("gini", PD).alias("gini"))


# A run that ends by the stopping rule: the accuracy over classes that the text
# says nothing about wavers, and a fall of more than STOP_DROP below the best ends it
# (after some dozens of steps at sf0.01).
STOP_STEPS, STOP_CHECK, STOP_DROP, STOP_ETA = 100, 10, 0.0075, 2e-6


def q_lr_train_to_stop(spark, sf_dir) -> DataFrame:
    """The history of a training run that stops by itself, and (kind ``stop``)
    the step at which it did."""
    w = _w(spark, sf_dir)
    res = L.train(w.features("train", False, WIDE_LABEL), w.features("validation", False, WIDE_LABEL),
                  w.classes(WIDE_LABEL).k, L.Schedule(STOP_STEPS, check_every=STOP_CHECK), STOP_ETA,
                  LR_PLAIN["lam"], STOP_DROP, stable=True)
    rows = [("check", i, round(tr, PD), round(va, PD)) for i, tr, va in res.history]
    rows.append(("stop" if res.stopped_early else "end", res.iterations, None, None))
    L.release(res.W)
    return spark.createDataFrame(rows, "kind string, iter int, train_accuracy double, validation_accuracy double")


def q_random_weights(spark, sf_dir) -> DataFrame:
    """W as a run with a random start begins."""
    w = _w(spark, sf_dir)
    return _weights_out(w, L.init_weights(w.features("train", True), w.k_lr, random_initial=True))


QUERIES = {
    "lr_train_to_stop": q_lr_train_to_stop,
    "random_weights": q_random_weights,
    "lr_probabilities_source": q_lr_probabilities_source,
    "uncertain_validation_documents": q_uncertain_validation_documents,
    "normalize_features": q_normalize_features,
    "lr_gradient_step": q_lr_gradient_step,
    "lr_train": q_lr_train,
    "normalize_weights": q_normalize_weights,
    "weight_diagnostics": q_weight_diagnostics,
    "lr_history": q_lr_history,
    "lr_probabilities": q_lr_probabilities,
    "lr_predict": q_lr_predict,
    "confusion_matrix_lr": q_confusion_matrix_lr,
    "lr_predict_raw": q_lr_predict_raw,
    "uncertain_documents": q_uncertain_documents,
}


# --- oracle SQL ----------------------------------------------------------------

def _features(name: str, docs_filter: str, normalize: bool, tok: str = "toks") -> list[str]:
    """CTEs x_<name>(doc_id, term, x) and r_<name>(doc_id, class_id, bias)."""
    x = ("cnt / sum(cnt) OVER (PARTITION BY term)" if normalize else "cnt")
    bias = f"1.0 / (SELECT count(*) FROM d_{name})" if normalize else "1.0"
    return [
        f"d_{name} AS MATERIALIZED ({docs_filter})",
        f"tf_{name} AS MATERIALIZED (SELECT t.doc_id, t.term, count(*)::DOUBLE AS cnt FROM {tok} t JOIN d_{name} d "
        f"USING (doc_id) GROUP BY t.doc_id, t.term)",
        f"x_{name} AS MATERIALIZED (SELECT doc_id, term, {x} AS x FROM tf_{name})",
        f"r_{name} AS (SELECT doc_id, class_id, {bias} AS bias FROM d_{name})",
    ]


def _probs(tag: str, W: str, split: str) -> list[str]:
    """CTE p_<tag>(doc_id, y, j, p)."""
    return [
        f"z_{tag} AS MATERIALIZED (SELECT x.doc_id, w.class_id AS j, sum(x.x * w.w) AS z FROM x_{split} x JOIN {W} w "
        f"ON w.term = x.term WHERE w.class_id < (SELECT k FROM kk) GROUP BY x.doc_id, w.class_id)",
        f"e_{tag} AS (SELECT r.doc_id, r.class_id AS y, c.class_id AS j, CASE WHEN c.class_id = (SELECT k FROM kk) "
        f"THEN 1.0 ELSE exp(coalesce(z.z, 0) + b.w * r.bias) END AS e FROM r_{split} r CROSS JOIN cls c "
        f"LEFT JOIN z_{tag} z ON z.doc_id = r.doc_id AND z.j = c.class_id "
        f"LEFT JOIN {W} b ON b.term = '' AND b.class_id = c.class_id)",
        f"p_{tag} AS MATERIALIZED (SELECT doc_id, y, j, e / sum(abs(e)) OVER (PARTITION BY doc_id) AS p FROM e_{tag})",
    ]


def _pred(tag: str) -> str:
    return (f"pr_{tag} AS (SELECT doc_id, y AS class_id, j AS predicted FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY doc_id ORDER BY p DESC, j) AS rk FROM p_{tag}) WHERE rk = 1)")


def _steps(n: int, eta: float, lam: float) -> list[str]:
    ctes = ["w0 AS MATERIALIZED (SELECT t.term, c.class_id, 0.0::DOUBLE AS w FROM (SELECT DISTINCT term FROM x_tr "
            "UNION ALL SELECT '') t CROSS JOIN cls c)"]
    for i in range(1, n + 1):
        prev = f"w{i - 1}"
        ctes += _probs(f"s{i}", prev, "tr")
        ctes.append(
            f"g{i} AS MATERIALIZED (SELECT x.term, p.j AS class_id, sum(x.x * (CASE WHEN p.y = p.j THEN 1.0 ELSE 0.0 END - p.p)) AS g "
            f"FROM x_tr x JOIN p_s{i} p USING (doc_id) GROUP BY x.term, p.j UNION ALL "
            f"SELECT '' AS term, p.j AS class_id, sum(r.bias * (CASE WHEN p.y = p.j THEN 1.0 ELSE 0.0 END - p.p)) AS g "
            f"FROM p_s{i} p JOIN r_tr r USING (doc_id) GROUP BY p.j)")
        ctes.append(
            f"w{i} AS MATERIALIZED (SELECT w.term, w.class_id, w.w + {eta!r} * (coalesce(g.g, 0) - {lam!r} * w.w) AS w "
            f"FROM {prev} w LEFT JOIN g{i} g ON g.term = w.term AND g.class_id = w.class_id)")
    return ctes


_TR = "SELECT doc_id, class_id FROM docs WHERE doc_id IN (SELECT doc_id FROM split WHERE split = 'train')"
_VA = "SELECT doc_id, class_id FROM docs WHERE doc_id IN (SELECT doc_id FROM split WHERE split = 'validation')"
_BM = "SELECT item_id AS doc_id, CAST(NULL AS INTEGER) AS class_id FROM benchmark"


def _base(normalize: bool, extra_splits: list[tuple[str, str, bool, str]] = (), label: str = LR_LABEL) -> list[str]:
    ctes = [S.toks(), S.toks("btoks", "benchmark", "item_id"), S.classes(label), S.split(),
            S.docs(label), "kk AS (SELECT max(class_id) AS k FROM cls)"]
    ctes += _features("tr", _TR, normalize)
    for name, filt, norm, tok in extra_splits:
        ctes += _features(name, filt, norm, tok)
    return ctes


def _oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    n_eta, n_lam = LR_NORMALISED["eta"], LR_NORMALISED["lam"]
    p_eta, p_lam = LR_PLAIN["eta"], LR_PLAIN["lam"]
    o["normalize_features"] = S.with_(_base(True), f"SELECT doc_id, term, round(x, {WD}) AS x FROM x_tr")
    one = _base(True) + _steps(1, n_eta, n_lam)
    o["lr_gradient_step"] = S.with_(one, f"SELECT term, class_id, round(w, {WD}) AS w FROM w1")
    u, v = (f"(('0x' || substr(h, {at}, 13))::BIGINT::DOUBLE" for at in (1, 14))
    o["random_weights"] = S.with_(
        _base(True) + ["hashed AS (SELECT t.term, c.class_id, md5('42:' || c.class_id || ':' || t.term) AS h FROM "
                       "(SELECT DISTINCT term FROM x_tr UNION ALL SELECT '') t CROSS JOIN cls c)"],
        f"SELECT term, class_id, round(0.005 * sqrt(-2 * ln({u} + 0.5::DOUBLE) / 4503599627370496::DOUBLE)) "
        f"* cos({v}) * {2 * math.pi / 2.0 ** 52!r}::DOUBLE), {WD}) AS w FROM hashed")
    o["normalize_weights"] = S.with_(
        one, "SELECT term, class_id, round(CASE WHEN s = 0 THEN w ELSE w / s END, 15) AS w FROM "
             "(SELECT term, class_id, w, sum(abs(w)) OVER () AS s FROM w1)")
    o["weight_diagnostics"] = S.with_(
        one, f"SELECT round(max(w), {WD}) AS max_w, round(sum(abs(w)), 6) AS abs_sum FROM w1")
    three = _base(True) + _steps(LR_STEPS, n_eta, n_lam)
    o["lr_train"] = S.with_(three, f"SELECT term, class_id, round(w, {WD}) AS w FROM w{LR_STEPS}")
    hist = _base(True, [("va", _VA, True, "toks")]) + _steps(LR_STEPS, n_eta, n_lam)
    acc_rows = []
    for i in range(1, LR_STEPS + 1):
        hist += _probs(f"ht{i}", f"w{i}", "tr") + [_pred(f"ht{i}")]
        hist += _probs(f"hv{i}", f"w{i}", "va") + [_pred(f"hv{i}")]
        acc_rows.append(
            f"SELECT {i} AS iter, (SELECT avg(CASE WHEN predicted = class_id THEN 1.0 ELSE 0.0 END) FROM pr_ht{i}) AS tr, "
            f"(SELECT avg(CASE WHEN predicted = class_id THEN 1.0 ELSE 0.0 END) FROM pr_hv{i}) AS va")
    hist += ["acc AS (" + " UNION ALL ".join(acc_rows) + ")",
             "flag AS (SELECT *, max(va) OVER (ORDER BY iter ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best "
             "FROM acc)",
             f"stop AS (SELECT coalesce(min(iter), {LR_STEPS + 1}) AS s FROM flag WHERE best - va > 0.05)"]
    o["lr_history"] = S.with_(
        hist, f"SELECT CAST(iter AS INTEGER) AS iter, round(tr, {PD}) AS train_accuracy, "
              f"round(va, {PD}) AS validation_accuracy FROM acc WHERE iter < (SELECT s FROM stop)")
    plain = _base(False, [("va", _VA, False, "toks"), ("bm", _BM, False, "btoks")]) + _steps(LR_STEPS, p_eta, p_lam)
    W3 = f"w{LR_STEPS}"
    pv = plain + _probs("pv", W3, "va")
    o["lr_probabilities"] = S.with_(pv, f"SELECT doc_id, j AS prob_class, round(p, {PD}) AS p FROM p_pv")
    o["lr_predict"] = S.with_(pv + [_pred("pv")], "SELECT doc_id, predicted FROM pr_pv")
    o["confusion_matrix_lr"] = S.with_(
        pv + [_pred("pv")],
        "SELECT a.class_id AS predicted, b.class_id AS actual, CAST(count(p.doc_id) AS BIGINT) AS n "
        "FROM cls a CROSS JOIN cls b LEFT JOIN pr_pv p ON p.predicted = a.class_id AND p.class_id = b.class_id "
        "GROUP BY a.class_id, b.class_id")
    wide = (_base(False, [("va", _VA, False, "toks")], WIDE_LABEL) + _steps(LR_STEPS, p_eta, p_lam)
            + _probs("pv", W3, "va"))
    o["lr_probabilities_source"] = S.with_(wide, f"SELECT doc_id, j AS prob_class, round(p, {PD}) AS p FROM p_pv")
    o["uncertain_validation_documents"] = S.with_(
        wide + ["unc AS (SELECT doc_id, -sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END) AS entropy, "
                "1 - sum(p * p) AS gini FROM p_pv GROUP BY doc_id)"],
        f"SELECT CAST(row_number() OVER (ORDER BY round(entropy, 9) DESC, doc_id) AS INTEGER) AS rank, doc_id, "
        f"round(entropy, {PD}) AS entropy, round(gini, {PD}) AS gini FROM unc "
        f"ORDER BY round(entropy, 9) DESC, doc_id LIMIT 100")
    raw = (_base(True, [("bm", _BM, False, "btoks")]) + _steps(LR_STEPS, n_eta, n_lam)
           + _probs("raw", W3, "bm") + [_pred("raw")])
    o["lr_predict_raw"] = S.with_(raw, "SELECT doc_id AS id, predicted FROM pr_raw")
    pb = plain + _probs("pb", W3, "bm")
    o["uncertain_documents"] = S.with_(
        pb + ["unc AS (SELECT doc_id, -sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END) AS entropy, "
              "1 - sum(p * p) AS gini FROM p_pb GROUP BY doc_id)"],
        f"SELECT CAST(row_number() OVER (ORDER BY round(gini, 9) DESC, doc_id) AS INTEGER) AS rank, doc_id, "
        f"round(entropy, {PD}) AS entropy, round(gini, {PD}) AS gini FROM unc "
        f"ORDER BY round(gini, 9) DESC, doc_id LIMIT 100")
    return o


ORACLE = _oracle()

"""Rankings: word usefulness by class entropy (R1) and document uncertainty (R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bowline.functions.numeric import plogp
from bowline.operators.counts import frequency_outlier_bounds
from bowline.operators.naive_bayes import NaiveBayesModel


def word_scores(model: NaiveBayesModel, vocab: DataFrame | None = None,
                include_last_class: bool = False) -> DataFrame:
    """(term, entropy_sum) for every vocabulary term.

    Filtered count f[y,t] = c[y,t] when the term's corpus total lies within
    avg +/- 2 sd, else 0; p = (f + beta) / (W_y + beta) (no V factor);
    entropy_sum = sum over classes 1..k-1 (all k with ``include_last_class``)
    of p log2 p.
    """
    k = model.k
    beta = model.beta
    bounds = frequency_outlier_bounds(model.counts, k, model.vocab_size, model.stats)
    words = model.stats.n_words
    upto = k if include_last_class else k - 1
    tot = sum((F.col(f"c_{j}") for j in range(1, k + 1)), F.lit(0))
    kept = (tot >= F.lit(bounds.low)) & (tot <= F.lit(bounds.high))
    # the model's counts already hold every vocabulary term; ``vocab`` adds more
    base = model.counts if vocab is None else vocab.join(model.counts, "term", "left")
    filled = base.select(
        "term", *[F.coalesce(F.col(f"c_{j}"), F.lit(0)).alias(f"c_{j}") for j in range(1, k + 1)])
    terms = []
    for j in range(1, upto + 1):
        f = F.when(kept, F.col(f"c_{j}")).otherwise(F.lit(0))
        p = (f + F.lit(beta)) / F.lit(words[j - 1] + beta)
        terms.append(plogp(p))
    total = sum(terms, F.lit(0.0)) if terms else F.lit(0.0)
    return filled.select("term", total.alias("entropy_sum"))


def with_words(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Replace the column index ``term`` by the word of ``vocabulary(term_id,
    term)`` (J5); an index without a word keeps its number as text."""
    words = vocabulary.select(F.col("term_id").alias("term"), F.col("term").alias("_word"))
    out = df.join(words, "term", "left")
    word = F.coalesce(F.col("_word"), F.col("term").cast("string")).alias("term")
    return out.select(*[word if c == "term" else F.col(c) for c in df.columns])


def word_ranking(model: NaiveBayesModel, vocab: DataFrame | None = None, num_words: int = 100,
                 include_last_class: bool = False, digits: int = 9, words: DataFrame | None = None) -> DataFrame:
    """Top ``num_words`` terms by ascending entropy sum (ties: term), as
    (rank, term, score) with score = -entropy_sum (the printed value).
    ``words`` is the vocabulary file's table where terms are column indexes.

    Ordering uses the sum rounded to ``digits`` places so summation order
    cannot swap near-equal terms. TakeOrderedAndProject keeps only the top rows
    per partition; the rank window then runs on those ``num_words`` rows.
    """
    scored = word_scores(model, vocab, include_last_class)
    if words is not None:
        scored = with_words(scored, words)
    top = scored.orderBy(F.round("entropy_sum", digits), "term").limit(num_words)
    w = Window.orderBy(F.round("entropy_sum", digits), "term")
    return top.select(F.row_number().over(w).alias("rank"), "term",
                      (-F.col("entropy_sum")).alias("score"))


def format_ranking(ranking: DataFrame) -> DataFrame:
    """(line) = "<rank>. <word>, <score>" for a text sink (K2)."""
    return ranking.select(F.format_string("%d. %s, %s", "rank", "term", F.col("score").cast("string"))
                          .alias("line"))


def parse_ranking(lines: DataFrame) -> DataFrame:
    """(rank, term, score) from the lines that ``format_ranking`` made."""
    line = r"^(\d+)\. (.*), ([^,]*)$"
    return lines.select(F.regexp_extract("value", line, 1).cast("int").alias("rank"),
                        F.regexp_extract("value", line, 2).alias("term"),
                        F.regexp_extract("value", line, 3).cast("double").alias("score"))


def uncertain_documents(probs: DataFrame, k: int, num_docs: int = 100, measure: str = "gini",
                        digits: int = 9) -> DataFrame:
    """Top ``num_docs`` documents by descending uncertainty of their class
    probabilities (p_1..p_k): (rank, doc_id, entropy, gini). Ties: doc_id."""
    from bowline.functions.numeric import entropy_of, gini_of
    ps = [F.col(f"p_{j}") for j in range(1, k + 1)]
    scored = probs.select("doc_id", entropy_of(ps).alias("entropy"), gini_of(ps).alias("gini"))
    order = [F.round(measure, digits).desc(), F.col("doc_id")]
    top = scored.orderBy(*order).limit(num_docs)
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"),
                      "doc_id", "entropy", "gini")

"""Model evaluation over prediction tables.

A prediction table carries (doc_id, class_id, predicted) where class_id is the
true class (NULL when unknown), so no join back to the labels is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.sources.corpus import ClassSet


def accuracy(preds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of labelled rows whose prediction equals the true class."""
    by = by or []
    labelled = preds.where(F.col("class_id").isNotNull())
    hit = (F.col("predicted") == F.col("class_id")).cast("double")
    agg = [F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n")]
    return labelled.groupBy(*by).agg(*agg) if by else labelled.agg(*agg)


def accuracy_value(preds: DataFrame) -> float:
    row = accuracy(preds).first()
    return float(row["accuracy"]) if row["accuracy"] is not None else float("nan")


def prediction_counts(preds: DataFrame) -> DataFrame:
    """(predicted, n): how often each class was predicted."""
    return preds.groupBy("predicted").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(preds: DataFrame, classes: ClassSet) -> DataFrame:
    """Dense k x k confusion matrix in long form (predicted, actual, n),
    row = predicted class, column = actual class, zero cells included.

    The observed cells come from one aggregate (at most k^2 rows); the grid of
    all k^2 cells is generated from the (checked, small) class dictionary.
    """
    spark = preds.sparkSession
    k = classes.k
    observed = (preds.where(F.col("class_id").isNotNull())
                     .groupBy(F.col("predicted"), F.col("class_id").alias("actual"))
                     .agg(F.count(F.lit(1)).alias("n")))
    grid = (spark.range(1, k + 1).select(F.col("id").cast("int").alias("predicted"))
                 .select("predicted", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("actual")))
    return (grid.join(F.broadcast(observed), ["predicted", "actual"], "left")
                .select("predicted", "actual", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def with_class_names(df: DataFrame, classes: DataFrame, columns: list[str]) -> DataFrame:
    """Each class id column c of ``columns`` gets a column ``<c>_name`` from the
    class table (class_id, name) of k rows (J6); an unknown id has a null name."""
    for c in columns:
        names = classes.select(F.col("class_id").alias(c), F.col("name").alias(f"{c}_name"))
        df = df.join(F.broadcast(names), c, "left")
    return df


def best_by_accuracy(acc: DataFrame, key: str = "beta") -> DataFrame:
    """The row with the highest accuracy; the smallest key wins ties."""
    best = acc.agg(F.max_by(F.col(key), F.struct(F.col("accuracy"), -F.col(key))).alias(key))
    return acc.join(best, key, "inner").select(key, "accuracy")

"""Ordered head/tail train-validation split (no shuffle of the data).

The first ``n - int(fraction * n)`` rows in key order are training rows, the
rest validation. Instead of numbering every row, the boundary key is found
exactly by histogram narrowing: each pass scans only the key column (column
pruned, filter pushed down) and returns at most ``BUCKETS`` rows to the driver
(a constant bound, independent of the data size).
The split is then the predicate ``key < boundary``, which pushes down into
every later scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 65536


@dataclass(frozen=True)
class SplitInfo:
    n: int
    n_train: int
    n_validation: int
    boundary: int | None  # first validation key; None when there is no validation row
    key: str

    def train(self) -> Column:
        if self.boundary is None:
            return F.col(self.key).isNotNull()
        return F.col(self.key) < F.lit(self.boundary)

    def validation(self) -> Column:
        if self.boundary is None:
            return F.lit(False)
        return F.col(self.key) >= F.lit(self.boundary)

    def label(self) -> Column:
        return F.when(self.train(), F.lit("train")).when(self.validation(), F.lit("validation"))


def kth_smallest(df: DataFrame, key: str, k: int, lo: int, hi: int) -> tuple[int, int]:
    """The value at 0-based position ``k`` of the sorted integer key column and
    the number of smaller keys."""
    keys = df.select(F.col(key).cast("bigint").alias("k")).where(F.col("k").isNotNull())
    below = 0
    while True:
        width = hi - lo + 1
        step = -(-width // BUCKETS)  # ceil
        rng = keys.where((F.col("k") >= F.lit(lo)) & (F.col("k") <= F.lit(hi)))
        if step == 1:
            bucket = F.col("k")
        else:
            bucket = F.floor((F.col("k").cast("decimal(20,0)") - F.lit(lo)) / F.lit(step)).cast("bigint")
        rows = (rng.groupBy(bucket.alias("b"))
                   .agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
                   .collect())
        rows.sort(key=lambda r: r["b"])
        for r in rows:
            if below + r["n"] > k:
                if r["lo"] == r["hi"]:
                    return r["lo"], below
                lo, hi = r["lo"], r["hi"]
                break
            below += r["n"]
        else:
            raise ValueError("position beyond the number of keys")


def ordered_split(df: DataFrame, validation_split: float = 0.2, key: str = "doc_id") -> SplitInfo:
    """Exact ordered split on an integer key. Rows without a key are in neither
    part. Rows that share the boundary key stay together, all in validation, and
    the counts say so."""
    stats = df.agg(F.count(key).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    n = int(stats["n"])
    n_val = int(validation_split * n)
    if n_val == 0:
        return SplitInfo(n, n, 0, None, key)
    boundary, smaller = kth_smallest(df, key, n - n_val, int(stats["lo"]), int(stats["hi"]))
    return SplitInfo(n, smaller, n - smaller, boundary, key)

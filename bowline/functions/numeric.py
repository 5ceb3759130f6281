"""Numeric helpers shared by the models (NULL-free where NumPy gives -inf/NaN)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NEG_INF = float("-inf")


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den = 0 (ANSI mode raises on a zero divisor)."""
    return F.when(den != 0, num / den)


def plogp(p: Column) -> Column:
    """p * log2(p), taken as 0 at p = 0 (the limit; NumPy would give NaN)."""
    return F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0))


def argmax_1based(values: list[Column]) -> Column:
    """1-based index of the largest value: first one on ties, NaN counts as the
    largest value (NumPy ``argmax`` rule)."""
    arr = F.array(*values)
    return F.array_position(arr, F.array_max(arr)).cast("int")


def entropy_of(ps: list[Column]) -> Column:
    """-sum p log2 p over a probability vector."""
    return -reduce(lambda a, b: a + b, [plogp(p) for p in ps])


def gini_of(ps: list[Column]) -> Column:
    """1 - sum p^2 over a probability vector."""
    return F.lit(1.0) - reduce(lambda a, b: a + b, [p * p for p in ps])

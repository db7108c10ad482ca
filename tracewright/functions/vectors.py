"""Expressions over vector columns (arrays of numbers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    """Neither NaN nor infinite; null for null."""
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def all_finite(vector: Column) -> Column:
    return F.forall(vector, finite)


def doubled(vector: Column) -> Column:
    """Widened before any arithmetic, as differences of 32-bit values lose digits."""
    return F.transform(vector, lambda x: x.cast("double"))


def absolute_delta(now: Column, before: Column) -> Column:
    return F.zip_with(now, before, lambda a, b: F.abs(a - b))


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def all_below(vector: Column, limits: Column) -> Column:
    return F.forall(F.zip_with(vector, limits, lambda a, b: a < b), lambda x: x)


def flattened(column: Column, rank: int) -> Column:
    """Nested arrays of ``rank`` levels as one flat array of doubles."""
    for _ in range(rank - 1):
        column = F.flatten(column)
    return doubled(column)


def unwrapped(column: Column) -> Column:
    """The value of a list that holds one; fails on any other size."""
    return F.when(F.size(column) == 1, F.get(column, F.lit(0))).otherwise(F.raise_error(F.lit("a list of other than one value")))

"""Arithmetic that gives the same bits in every engine: integer cents, and rounding by floor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3_600_000_000
DAY = 24 * HOUR


def round4(x: Column) -> Column:
    return F.floor(x * 10000 + 0.5) / 10000


def ratio(part: Column, whole: Column) -> Column:
    """part / max(whole, 1)."""
    return part / F.greatest(whole, F.lit(1))


def mean_cents(total: Column, n: Column) -> Column:
    return total.cast("double") / n / 100


def spread(n: Column, total: Column, squares: Column) -> Column:
    """n * sqrt(n) times the population standard deviation, in exact integers under the root: sqrt(n * sum(x*x) - sum(x)^2)."""
    n = n.cast("decimal(18,0)")
    return F.sqrt((n * squares.cast("decimal(20,0)")).cast("decimal(38,0)").cast("double") - (total.cast("decimal(19,0)") * total.cast("decimal(19,0)")).cast("decimal(38,0)").cast("double"))


def stddev_cents(n: Column, total: Column, squares: Column) -> Column:
    return F.when(n > 1, spread(n, total, squares) / n / 100).otherwise(0.0)


def zscore(x: Column, n: Column, total: Column, squares: Column) -> Column:
    s = spread(n, total, squares)
    return F.when((n > 1) & (s > 0), (x.cast("double") * n - total.cast("double")) / s).otherwise(0.0)

"""Aggregate expressions whose built-in form uses another bias correction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_skewness(name: str) -> Column:
    """Skewness with small-sample correction; null below three values."""
    n = F.count(name).cast("double")
    return F.when(n > 2, F.skewness(name) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(name: str) -> Column:
    """Excess kurtosis with small-sample correction; null below four values."""
    n = F.count(name).cast("double")
    scale = (n - 1) / ((n - 2) * (n - 3))
    return F.when(n > 3, scale * ((n + 1) * F.kurtosis(name) + 6))


def pearson(x: str, y: str) -> Column:
    """Correlation over rows where both are known; null if either is constant there.

    The built-in ``corr`` fails on a constant column in ANSI mode.
    """
    both_x = F.when(F.col(y).isNotNull(), F.col(x))
    both_y = F.when(F.col(x).isNotNull(), F.col(y))
    spread = F.stddev_pop(both_x) * F.stddev_pop(both_y)
    return F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0)))

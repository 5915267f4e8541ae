"""Least squares per series from sums of products: one pass over the rows for any number of series."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.order import join_series
from seriesmill.session import lookup


def _solver(size: int, intercept: bool):
    """Arrow function from means and packed (co)variances, or mean products, to coefficients of many series."""
    upper = np.triu_indices(size + 1)

    @F.pandas_udf("array<double>")
    def solve(means: pd.Series, packed: pd.Series) -> pd.Series:
        full = np.zeros((len(packed), size + 1, size + 1))
        full[:, upper[0], upper[1]] = np.stack(packed.to_numpy())
        full[:, upper[1], upper[0]] = full[:, upper[0], upper[1]]
        centre = np.stack(means.to_numpy())
        spread = np.sqrt(np.maximum(np.einsum("kii->ki", full), 0))
        # What is left of a constant column is rounding.
        spread[spread <= 1e-13 * np.abs(centre)] = 0.0
        inverse_spread = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
        scaled = full * inverse_spread[:, :, None] * inverse_spread[:, None, :]
        # The pseudo-inverse also answers for short or constant series.
        inverse = np.linalg.pinv(scaled[:, :size, :size], rcond=1e-12, hermitian=True)
        found = np.einsum("kij,kj->ki", inverse, scaled[:, :size, size])
        slopes = found * spread[:, size:] * inverse_spread[:, :size]
        if intercept:
            level = centre[:, size] - np.einsum("ki,ki->k", slopes, centre[:, :size])
            slopes = np.column_stack([slopes, level])
        return pd.Series(list(slopes))

    return solve


def fit_linear(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    keys: Sequence[str] = (),
    intercept: bool = True,
) -> DataFrame:
    """(keys.., n, coefficients) by ordinary least squares over complete rows.

    ``coefficients`` follows ``features``, then the intercept if there is one. One aggregation gives
    means and covariances (mean products without an intercept); columns are solved in units of their spread, so
    neither a large offset nor columns of very different size cost digits.
    """
    names = [*features, target]
    pairs = list(combinations_with_replacement(names, 2))
    if intercept:
        products = [F.var_pop(a) if a == b else F.covar_pop(a, b) for a, b in pairs]
    else:
        products = [F.avg(F.col(a) * F.col(b)) for a, b in pairs]
    means = [F.avg(name) if intercept else F.lit(0.0) for name in names]
    sums = df.na.drop("any", subset=names).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*means).alias("means"), F.array(*products).alias("products")
    )
    solve = _solver(len(features), intercept)
    return sums.where(F.col("n") > 0).select(*keys, "n", solve("means", "products").alias("coefficients"))


def linear_value(features: Sequence[str], coefficients: Column, intercept: bool = True) -> Column:
    """Sum of features times coefficients; null where a feature is null."""
    total = F.element_at(coefficients, len(features) + 1) if intercept else F.lit(0.0)
    for i, name in enumerate(features, 1):
        total = total + F.col(name) * F.element_at(coefficients, i)
    return total


def predict_linear(
    df: DataFrame,
    model: DataFrame,
    features: Sequence[str],
    out: str = "predicted",
    keys: Sequence[str] = (),
    intercept: bool = True,
) -> DataFrame:
    """Add ``out`` from the fitted coefficients of the row's series; null for an unknown series."""
    if not keys:
        coefficients = model.select("coefficients").scalar()
        return df.withColumn(out, linear_value(features, coefficients, intercept))
    joined = join_series(df, lookup(model.select(*keys, "coefficients")), keys)
    value = linear_value(features, F.col("coefficients"), intercept)
    return joined.withColumn(out, value).drop("coefficients")

"""Encodings and scalings as plain columns, fitted on the rows of choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.order import with_position
from seriesmill.session import lookup

MAX_CATEGORIES = 1000


def categories(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct known values, for one column each; an error beyond ``limit`` of them (a parameter)."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1)
    values = sorted(row[0] for row in found.collect())
    if len(values) > limit:
        raise ValueError(f"{column} has more than {limit} categories")
    return values


def one_hot(
    df: DataFrame,
    column: str,
    values: Sequence[str] | None = None,
    drop: str = "first",
    unknown: str = "error",
) -> DataFrame:
    """Add ``<column>_<value>`` as 0.0 / 1.0 next to the column.

    ``drop='first'`` leaves out the alphabetically first category. A value outside
    ``values`` fails the query, or gives zeros with ``unknown='ignore'``.
    """
    values = list(values) if values is not None else categories(df, column)
    kept = values[1:] if drop == "first" else values
    known = F.col(column).isin(values)
    failure = F.raise_error(
        F.concat(F.lit(f"unknown {column}: "), F.coalesce(F.col(column), F.lit("null")))
    ).cast("double")
    checked = F.lit(0.0) if unknown == "ignore" else F.when(known, 0.0).otherwise(failure)
    return df.withColumns(
        {f"{column}_{v}": F.when(F.col(column) == v, 1.0).otherwise(checked) for v in kept}
    )


def label_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the alphabetical rank of the category, from 0; any number of categories, null for null."""
    values = df.select(F.col(column).alias("_category")).where(F.col(column).isNotNull()).distinct()
    ranks = with_position(values, ["_category"], "_code").select("_category", F.col("_code").cast("int").alias(out))
    ranks = lookup(ranks)
    return df.join(ranks, df[column] == ranks["_category"], "left").drop("_category")


def _fitted_on(df: DataFrame, fit_on: Column | None) -> DataFrame:
    return df if fit_on is None else df.where(fit_on)


def standardised(
    df: DataFrame,
    columns: Sequence[str],
    fit_on: Column | None = None,
    suffix: str = "",
) -> DataFrame:
    """Columns minus their mean, over their population deviation; 0 for a constant column."""
    fitted = (
        _fitted_on(df, fit_on)
        .agg(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
        )
        .first()
    )
    return df.withColumns(
        {
            c + suffix: (F.col(c) - F.lit(fitted[f"{c}_mean"])) / F.lit(fitted[f"{c}_std"] or 1.0)
            for c in columns
        }
    )


def extremes(df: DataFrame, column: str, fit_on: Column | None = None) -> tuple[float, float]:
    """Smallest and largest value of a column as driver numbers."""
    row = _fitted_on(df, fit_on).agg(F.min(column), F.max(column)).first()
    return row[0], row[1]


def min_max_scaled(column: Column, low: float, high: float) -> Column:
    """Map [low, high] to [0, 1] without clipping; 0 at the low end of a constant column."""
    return (column - F.lit(low)) / F.lit((high - low) or 1.0)


def min_max_restored(column: Column, low: float, high: float) -> Column:
    """Inverse of ``min_max_scaled``."""
    return column * F.lit((high - low) or 1.0) + F.lit(low)

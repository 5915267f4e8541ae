"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The four categories in calendar order.
SEASONS = ("Spring", "Summer", "Autumn", "Winter")


def season_of(month: Column) -> Column:
    """Meteorological season of a month number."""
    return (
        F.when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .when(month.between(9, 11), "Autumn")
        .otherwise("Winter")
    )


def month_start(year: Column, month: Column) -> Column:
    """First day of a calendar month as a date."""
    return F.make_date(year, month, F.lit(1))


def half_even(value: Column, digits: int) -> Column:
    """Round with ties to the even neighbour, as numeric array libraries do."""
    return F.bround(value, digits)


def right_closed_bin(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (lower, upper] that holds ``value``; null outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    result = F.lit(None).cast("string")
    for lower, upper, label in zip(edges[:-1], edges[1:], labels):
        result = F.when((value > lower) & (value <= upper), label).otherwise(result)
    return result


def without_step_prefix(name: Column) -> Column:
    """Drop the ``step__`` prefix of an encoded feature name."""
    return F.regexp_replace(name, "^[a-z]+__", "")


def share_of_total(value: Column, total: Column) -> Column:
    """``value`` as a percentage of ``total``; null for a zero total."""
    return F.try_divide(value, total) * 100


def product(*names: str) -> Column:
    """Interaction term: the product of the named columns."""
    result = F.col(names[0])
    for name in names[1:]:
        result = result * F.col(name)
    return result


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, read from the schema."""
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in exclude
    ]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in floating point columns, so that aggregates skip it."""
    floats = [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({name: F.nanvl(F.col(name), F.lit(None)) for name in floats})

"""Profiles of a table and of single columns."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.columns import numeric_columns
from seriesmill.functions.moments import sample_kurtosis, sample_skewness
from seriesmill.operators.quantiles import exact_quantiles
from seriesmill.session import lookup


def shape(df: DataFrame) -> DataFrame:
    """(column_name, data_type, rows), one row per column."""
    fields = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col("_rows").alias("rows"),
        )
        for name, kind in df.dtypes
    ]
    return df.agg(F.count(F.lit(1)).alias("_rows")).select(F.inline(F.array(*fields)))


def head(df: DataFrame, order_by: Sequence[str], k: int = 5) -> DataFrame:
    """First k rows in order; planned as a bounded top-k, not as a full sort."""
    return df.orderBy(*order_by).limit(k)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, count, mean, std, min, p25, p50, p75, max) per numeric column."""
    columns = list(columns or numeric_columns(df))
    packed = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    moments = df.agg(F.array(*packed).alias("_all")).select(F.inline("_all"))
    points = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    quartiles = (
        exact_quantiles(df, columns, list(points))
        .groupBy("column_name")
        .agg(
            *[
                F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
                for p, name in points.items()
            ]
        )
    )
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def summary(df: DataFrame, column: str) -> DataFrame:
    """One row: mean, median, min, max and sample deviation of a column."""
    middle = exact_quantiles(df, [column], [0.5]).select(F.col("value"))
    return df.agg(
        F.avg(column).alias("mean"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.stddev_samp(column).alias("std"),
    ).select("mean", middle.scalar().alias("median"), "min", "max", "std")


def distribution_shape(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, skewness, kurtosis), both with small-sample correction."""
    packed = [
        F.struct(
            F.lit(c).alias("column_name"),
            sample_skewness(c).alias("skewness"),
            sample_kurtosis(c).alias("kurtosis"),
        )
        for c in columns
    ]
    return df.agg(F.array(*packed).alias("_all")).select(F.inline("_all"))


def _extent(df: DataFrame, column: str):
    return df.agg(
        F.count(column).alias("n"),
        F.min(column).cast("double").alias("lo"),
        F.max(column).cast("double").alias("hi"),
        F.stddev_samp(column).alias("std"),
    ).first()


def histogram(
    df: DataFrame, column: str, bins: int, extent: tuple[float, float] | None = None
) -> DataFrame:
    """(bin, lower, upper, count) over equal-width bins; the last bin includes its upper edge.

    Bins without rows are kept. ``extent`` fixes the edges; values outside are left out.
    """
    if extent is None:
        found = _extent(df, column)
        extent = (found["lo"], found["hi"])
    low, high = extent
    numbers = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if low is None:
        return numbers.select(
            "bin",
            F.lit(None).cast("double").alias("lower"),
            F.lit(None).cast("double").alias("upper"),
            F.lit(0).cast("long").alias("count"),
        )
    if low == high:  # one value: a bin range of width one around it
        low, high = low - 0.5, high + 0.5
    value = F.col(column).cast("double")
    place = F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)).cast("int")
    counted = (
        df.where(value.between(low, high))
        .groupBy(F.least(place, F.lit(bins)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    width = (high - low) / bins
    return numbers.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("upper"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
    )


def density(
    df: DataFrame,
    column: str,
    points: int = 200,
    extent: tuple[float, float] | None = None,
    cells: int | None = None,
) -> DataFrame:
    """(point, x, density): Gaussian kernel density on an even grid between the extremes.

    Bandwidth by Scott's rule. A task adds its values into one vector over the grid,
    so no row is copied and one partial sum per grid point and task is shuffled. With ``cells``
    the values are first merged into that many equal-width cells, each standing for
    its rows at their mean: an approximation that costs one exponential per cell and
    grid point instead of one per row and grid point.
    """
    found = _extent(df, column)
    low, high = extent or (found["lo"], found["hi"])
    n, spread = found["n"], found["std"]
    if not n or not spread:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    bandwidth = spread * n ** (-1 / 5)
    step = (high - low) / (points - 1)
    value = F.col(column).cast("double")
    weighted = df.where(value.isNotNull()).select(value.alias("_value"), F.lit(1).alias("_weight"))
    if cells:
        width = (found["hi"] - found["lo"]) / cells
        cell = F.floor((F.col("_value") - F.lit(found["lo"])) / F.lit(width))
        weighted = weighted.groupBy(F.least(cell, F.lit(cells - 1)).alias("_cell")).agg(
            F.avg("_value").alias("_value"), F.count(F.lit(1)).alias("_weight")
        )
    sums = weighted.select("_value", F.col("_weight").cast("double")).mapInArrow(
        _kernel_sums(low, step, points, bandwidth), "point int, _sum double"
    )
    return sums.groupBy("point").agg(
        F.first(F.lit(low) + F.col("point") * F.lit(step)).alias("x"),
        (F.sum("_sum") / F.lit(n * bandwidth * math.sqrt(2 * math.pi))).alias("density"),
    )


#: Values met with the whole grid at a time.
_KERNEL_ROWS = 4096


def _kernel_sums(low: float, step: float, points: int, bandwidth: float):
    """One vector of sums over the grid per task, returned once as (point, sum)."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, held = low + np.arange(points) * step, np.zeros(points)
        for batch in source:
            values, weights = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for at in range(0, len(values), _KERNEL_ROWS):
                distance = (grid[:, None] - values[at : at + _KERNEL_ROWS]) / bandwidth
                held += np.exp(-0.5 * distance * distance) @ weights[at : at + _KERNEL_ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(range(points), pa.int32()), pa.array(held)], ["point", "_sum"])

    return run


def box_plot(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Box-plot numbers per column (and group).

    (by.., column_name, q1, median, q3, whisker_low, whisker_high, outliers). Whiskers
    end at the furthest value within 1.5 times the quartile range.
    """
    points = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    group = [*by, "column_name"]
    boxes = (
        exact_quantiles(df, columns, list(points), by)
        .where(F.col("value").isNotNull())
        .groupBy(*group)
        .agg(
            *[
                F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
                for p, name in points.items()
            ]
        )
    )
    # Boxes of a group stand side by side in one row, so rows are met as they are, without a copy per column.
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    box = F.struct("q1", "median", "q3")
    wide = boxes.groupBy(key.alias("_by")).agg(
        *[F.first(F.when(F.col("column_name") == c, box), ignorenulls=True).alias(f"_box{i}") for i, c in enumerate(columns)]
    )
    known = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"_v{i}") for i, c in enumerate(columns)]
    rows = df.select(key.alias("_by"), *known).join(lookup(wide), "_by")

    def found(i: int, c: str) -> Column:
        value, each = F.col(f"_v{i}"), F.col(f"_box{i}")
        reach = 1.5 * (each["q3"] - each["q1"])
        inside = value.between(each["q1"] - reach, each["q3"] + reach)
        return F.struct(
            F.lit(c).alias("column_name"),
            F.first(each, ignorenulls=True).alias("_box"),
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )

    each = rows.groupBy("_by").agg(F.array(*[found(i, c) for i, c in enumerate(columns)]).alias("_all"))
    each = each.select("_by", F.inline("_all")).where("_box IS NOT NULL")
    return each.select(*(["_by.*"] if by else []), "column_name", "_box.*", "whisker_low", "whisker_high", "outliers")

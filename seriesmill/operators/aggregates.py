"""Calendar and category aggregates, binned errors and small reports on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions.columns import SEASONS, month_start, share_of_total


def monthly_mean(
    df: DataFrame,
    value: str,
    year: str = "year",
    month: str = "month",
    keys: Sequence[str] = (),
    fill_gaps: bool = False,
) -> DataFrame:
    """(keys.., month_start, price, n): mean of ``value`` per calendar month.

    Months without rows are absent unless ``fill_gaps`` adds them with a null price,
    from each key's first to its last month.
    """
    months = (
        df.groupBy(*keys, year, month)
        .agg(F.avg(value).alias("price"), F.count(F.lit(1)).alias("n"))
        .select(
            *keys, month_start(F.col(year), F.col(month)).alias("month_start"), "price", "n"
        )
    )
    if not fill_gaps:
        return months
    # Every month brings the gap after it, so one sort per key makes the calendar and no table of it is hashed.
    order = Window.partitionBy(*keys).orderBy("month_start")
    same = order.rangeBetween(Window.currentRow, Window.currentRow)
    last = F.coalesce(F.add_months(F.lead("month_start").over(order), -1), F.col("month_start"))
    spans = months.select(
        *keys, "month_start", F.max("price").over(same).cast("double").alias("price"), F.max("n").over(same).alias("n"),
        last.alias("_last"), F.row_number().over(order).alias("_place"),
    ).where("month_start IS NOT NULL OR _place = 1")  # rows without a month come first and are one
    every = F.sequence("month_start", "_last", F.expr("interval 1 month"))
    known = F.col("_month").eqNullSafe(F.col("month_start"))
    return spans.select("*", F.explode_outer(every).alias("_month")).select(
        *keys, F.col("_month").alias("month_start"), F.when(known, F.col("price")).alias("price"), F.when(known, F.col("n")).otherwise(0).alias("n")
    )


def series_extent(months: DataFrame) -> DataFrame:
    """One row: number of months, first and last month."""
    return months.agg(
        F.count(F.lit(1)).alias("months"),
        F.min("month_start").alias("first_month"),
        F.max("month_start").alias("last_month"),
    )


def category_stats(
    df: DataFrame, category: str, value: str, order: Sequence[str] = SEASONS
) -> DataFrame:
    """(ordinal, category, mean, std) in the given order; an absent category gets nulls."""
    positions = F.inline(
        F.array(
            *[
                F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias(category))
                for i, name in enumerate(order, 1)
            ]
        )
    )
    wanted = df.sparkSession.range(1).select(positions)
    found = df.groupBy(category).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )
    return wanted.join(found, category, "left").select("ordinal", category, "mean", "std")


def yearly_band(df: DataFrame, value: str, year: str = "year") -> DataFrame:
    """(year, mean, std, lower, upper): mean per year with a band of one sample deviation."""
    return (
        df.groupBy(year)
        .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
        .withColumns(
            {"lower": F.col("mean") - F.col("std"), "upper": F.col("mean") + F.col("std")}
        )
    )


def with_share(small: DataFrame, value: str, out: str = "pct") -> DataFrame:
    """Add the percentage of the column total to an already aggregated (short) table."""
    total = F.sum(value).over(Window.partitionBy())
    return small.withColumn(out, share_of_total(F.col(value), total))


def mean_by_bin(df: DataFrame, bin_column: str, value: str) -> DataFrame:
    """(bin, n, mean) over rows that fall in a bin; empty bins do not appear."""
    return (
        df.where(F.col(bin_column).isNotNull())
        .groupBy(bin_column)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias(f"mean_{value}"))
    )


def population_shift(
    df: DataFrame, column: str, period: str, base: str, bins: int = 10, floor: float = 1e-6
) -> DataFrame:
    """(period, psi): population stability index of each period against period ``base``.

    Bins are equal-width over the whole column. Shares below ``floor`` are raised to it.
    """
    extent = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if extent["lo"] is None or extent["lo"] == extent["hi"]:
        raise ValueError(f"{column} has no spread")
    place = F.least(
        F.width_bucket(F.col(column), F.lit(extent["lo"]), F.lit(extent["hi"]), F.lit(bins)),
        F.lit(bins),
    )
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(period).cast("string").alias("period"), place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # From here on there are at most (periods x bins) rows.
    periods = counts.groupBy("period").agg(F.sum("n").alias("total"))
    cells = periods.select(
        "period", "total", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    )
    shares = cells.join(
        counts.select("period", F.col("bin").cast("int").alias("bin"), "n"),
        ["period", "bin"],
        "left",
    ).select(
        "period",
        "bin",
        F.greatest(F.coalesce("n", F.lit(0)) / F.col("total"), F.lit(floor)).alias("share"),
    )
    reference = shares.where(F.col("period") == base).select("bin", F.col("share").alias("base"))
    gap = F.col("share") - F.col("base")
    return (
        shares.join(reference, "bin")
        .groupBy("period")
        .agg(F.sum(gap * F.ln(F.col("share") / F.col("base"))).alias("psi"))
    )

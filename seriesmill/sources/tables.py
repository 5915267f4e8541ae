"""Parquet tables and the observation view built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.columns import nan_to_null, season_of

ORDER_KEYS = ("obs_ts", "obs_id")
CALENDAR = ("year", "month", "day", "season")
LINE_DRIVERS = ("qty", "disc", "tax", "ext", "n_lines", "spend")
CUSTOMER_COLUMNS = ("series_key", "acctbal")
ALL_COLUMNS = ("obs_id", "obs_ts", *CALENDAR, "price", *LINE_DRIVERS, *CUSTOMER_COLUMNS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; NaN is read as null."""
    return nan_to_null(spark.read.parquet(f"{folder}/{name}.parquet"))


def observations(
    spark: SparkSession, folder: str, columns: Sequence[str] = ALL_COLUMNS
) -> DataFrame:
    """One row per order: the time-ordered observation table.

    Only the joins that the wanted columns need are part of the plan. Line items
    are aggregated before the join, so the join moves one row per order. Join
    strategies are left to adaptive execution, which knows the real sizes.
    Sums are kept to cents and averages to six digits.
    """
    ts = F.col("o_orderdate")
    month = F.month(ts).cast("int")
    out = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("obs_id"),
        ts.alias("obs_ts"),
        F.year(ts).cast("int").alias("year"),
        month.alias("month"),
        F.dayofmonth(ts).cast("int").alias("day"),
        season_of(month).alias("season"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey"),
    )
    if set(columns) & set(LINE_DRIVERS):
        aggregates = {
            "qty": F.sum("l_quantity"),
            "disc": F.round(F.avg("l_discount"), 6),
            "tax": F.round(F.avg("l_tax"), 6),
            "ext": F.round(F.avg("l_extendedprice"), 6),
            "n_lines": F.count(F.lit(1)).cast("double"),
            "spend": F.round(F.sum("l_extendedprice"), 2),
        }
        lines = (
            table(spark, folder, "lineitem")
            .groupBy(F.col("l_orderkey").alias("obs_id"))
            .agg(*[aggregates[name].alias(name) for name in LINE_DRIVERS if name in columns])
        )
        out = out.join(lines, "obs_id", "left")
    if set(columns) & set(CUSTOMER_COLUMNS):
        customers = table(spark, folder, "customer").select(
            F.col("c_custkey").alias("o_custkey"),
            F.col("c_mktsegment").alias("series_key"),
            F.col("c_acctbal").alias("acctbal"),
        )
        out = out.join(customers, "o_custkey", "left")
    return out.select(*columns)

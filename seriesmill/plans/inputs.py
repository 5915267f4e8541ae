"""Inputs that several registered queries start from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.operators.aggregates import monthly_mean
from seriesmill.operators.features import ORDER_FEATURES, engineer
from seriesmill.operators.order import with_position
from seriesmill.operators.splits import temporal_split
from seriesmill.operators.windows import lagged
from seriesmill.session import stage
from seriesmill.sources.tables import ALL_COLUMNS, ORDER_KEYS, observations


def ordered(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """The wanted observation columns with their position in time order."""
    wanted = [*ORDER_KEYS, *[c for c in columns if c not in ORDER_KEYS]]
    return with_position(observations(spark, folder, wanted), ORDER_KEYS)


def staged(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """The wanted observation columns, joined once, for operators that read them several times."""
    return stage(observations(spark, folder, columns), "observations")


def with_previous_price(df: DataFrame) -> DataFrame:
    """Add ``previous_price``; null on the first row."""
    return lagged(df, ["price"], head="null").withColumnRenamed("price_lag", "previous_price")


def engineered(spark: SparkSession, folder: str) -> DataFrame:
    """The engineered table over orders."""
    columns = [c for c in ALL_COLUMNS if c != "spend"]
    return engineer(with_previous_price(ordered(spark, folder, columns)), ORDER_FEATURES)


def monthly_prices(spark: SparkSession, folder: str, keys: Sequence[str] = ()) -> DataFrame:
    columns = ["year", "month", "price", *keys]
    return monthly_mean(observations(spark, folder, columns), "price", keys=keys)


def fixed_predictions(
    spark: SparkSession, folder: str, carry: Sequence[str] = ("obs_id",)
) -> DataFrame:
    """Two predictors that need no fitting: the previous price and the training mean.

    (model, split, idx, carry.., actual, predicted)
    """
    rows = with_previous_price(temporal_split(ordered(spark, folder, ["price", *carry])))
    mean = rows.where(F.col("split") == "train").agg(F.avg("price")).scalar()
    guesses = [("previous", F.col("previous_price")), ("train_mean", mean)]
    models = F.array(
        *[F.struct(F.lit(m).alias("model"), p.alias("predicted")) for m, p in guesses]
    )
    return (
        rows.withColumn("_guess", F.explode(models))
        .select(
            F.col("_guess.model").alias("model"),
            "split",
            "idx",
            *carry,
            F.col("price").alias("actual"),
            F.col("_guess.predicted").alias("predicted"),
        )
        .where(F.col("predicted").isNotNull())
    )


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Round result columns for comparison with another engine."""
    return df.withColumns({c: F.round(c, digits) for c in columns})

"""Regression metrics and error reports over (model, idx, actual, predicted) rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions.columns import half_even
from seriesmill.operators.quantiles import exact_quantiles

# Fixed value: smallest denominator of a percentage error (double precision machine epsilon).
EPSILON = 2.220446049250313e-16


def regression_metrics(
    predictions: DataFrame,
    by: Sequence[str] = ("model",),
    actual: str = "actual",
    predicted: str = "predicted",
) -> DataFrame:
    """(by.., n, rmse, mae, mape_pct, r2) in one aggregation; rows without a prediction are left out.

    r2 of a constant actual is 1 for a perfect prediction and 0 otherwise; below two rows it is null.
    """
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    n = F.count(F.lit(1))
    squared = F.sum(error * error)
    total = F.var_pop(y) * n
    r2 = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(total > 0, 1 - F.try_divide(squared, total))
        .when(squared == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return (
        predictions.where(y.isNotNull() & p.isNotNull())
        .groupBy(*by)
        .agg(
            n.alias("n"),
            F.sqrt(squared / n).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            (F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(EPSILON))) * 100).alias("mape_pct"),
            r2.alias("r2"),
        )
    )


def as_predictions(
    df: DataFrame, model: str, grain: str, actual: str, predicted: str, idx: str = "idx", **extra
) -> DataFrame:
    """Long prediction rows (model, grain, idx, actual, predicted, extra..) of one model."""
    return df.select(
        F.lit(model).alias("model"),
        F.lit(grain).alias("grain"),
        F.col(idx).cast("long").alias("idx"),
        F.col(actual).cast("double").alias("actual"),
        F.col(predicted).cast("double").alias("predicted"),
        *[F.col(source).alias(name) for name, source in extra.items()],
    )


def compare_models(predictions: Sequence[DataFrame]) -> DataFrame:
    """Stack prediction rows and compare models: one row per model, rounded for reading."""
    stacked = reduce(DataFrame.unionByName, predictions)
    digits = {"rmse": 4, "mae": 4, "mape_pct": 2, "r2": 4}
    return regression_metrics(stacked, ("model", "grain")).withColumns(
        {name: half_even(F.col(name), d) for name, d in digits.items()}
    )


def with_errors(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Add ``residual`` and ``abs_error``."""
    residual = F.col(actual) - F.col(predicted)
    return df.withColumns({"residual": residual, "abs_error": F.abs(residual)})


def residual_summary(df: DataFrame, residual: str = "residual") -> DataFrame:
    """One row: mean, population deviation, min and max of the residuals."""
    return df.agg(
        F.avg(residual).alias("mean"),
        F.stddev_pop(residual).alias("std"),
        F.min(residual).alias("min"),
        F.max(residual).alias("max"),
    )


def worst_predictions(
    df: DataFrame, k: int = 20, error: str = "abs_error", idx: str = "idx"
) -> DataFrame:
    """The k rows with the largest error; the earlier row first on ties."""
    return df.orderBy(F.desc(error), F.asc(idx)).limit(k)


def fold_summary(per_fold: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of the RMSE over folds."""
    return per_fold.groupBy(*by).agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("rmse").alias("mean_rmse"),
        F.stddev_pop("rmse").alias("std_rmse"),
    )


def generalisation_gap(per_split: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(by.., train_rmse, test_rmse, gap) from metrics per split."""

    def of(split: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col("rmse")))

    return (
        per_split.groupBy(*by)
        .agg(of("train").alias("train_rmse"), of("test").alias("test_rmse"))
        .withColumn("gap", F.col("test_rmse") - F.col("train_rmse"))
    )


def error_by_level(metrics: DataFrame, levels: Sequence[float]) -> DataFrame:
    """Add (level, error_pct): the RMSE as a percentage of each reference level."""
    each = F.explode(F.array(*[F.lit(float(v)) for v in levels]))
    return metrics.withColumn("level", each).withColumn(
        "error_pct", F.col("rmse") / F.col("level") * 100
    )


def improvement_over(metrics: DataFrame, base: str) -> DataFrame:
    """Add ``improvement_pct``: how far the RMSE is below that of model ``base``."""
    # One row per model: a handful, so one task is enough and nothing is evaluated twice.
    base_rmse = F.max(F.when(F.col("model") == base, F.col("rmse"))).over(Window.partitionBy())
    return metrics.withColumn(
        "improvement_pct", F.try_divide(base_rmse - F.col("rmse"), base_rmse) * 100
    )


#: P(Poisson(1) <= k) for k = 0, 1, ..; a draw beyond the last one counts as one more.
POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(8)]


#: Draws of a task, at most, so that tasks follow the draws and not the few bytes of the rows they are made for.
DRAWS_PER_TASK = 4_000_000


def resampling_weight(idx: Column, replicate: Column, seed: int = 42) -> Column:
    """How often a row occurs in a bootstrap replicate: a Poisson draw from a hash of both, the same on any layout.

    The draw is the number that the first 8 hexadecimal digits of the hash are, over 2 ** 32. Digits compare as numbers do.
    """
    digits = F.md5(F.concat_ws(":", F.lit(seed), idx.cast("string"), replicate.cast("string")))
    return sum(((digits >= f"{math.ceil(limit * (1 << 32)):08x}").cast("int") for limit in POISSON), F.lit(0))


def bootstrap_scores(
    predictions: DataFrame, keys: Sequence[str] = ("model",), replicates: int = 200, seed: int = 42, idx: str = "idx"
) -> DataFrame:
    """(keys.., replicate, n, rmse, mae) on rows drawn with replacement: all replicates in one aggregation.

    Every row meets its replicates in its own task and is summed there; only sums are shuffled. ``predictions``
    should be staged, since they are counted first.
    """
    tasks = predictions.count() * replicates // DRAWS_PER_TASK + 1
    spread = predictions.repartition(tasks, idx, *keys)
    each = spread.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    weighed = each.withColumn("_w", resampling_weight(F.col(idx), F.col("replicate"), seed))
    error = F.col("actual") - F.col("predicted")
    drawn = F.col("_w") > 0  # a row that is not drawn counts nowhere, whatever its error
    sums = weighed.groupBy(*keys, "replicate").agg(
        F.sum("_w").alias("n"),
        F.sum(F.when(drawn, F.col("_w") * error * error)).alias("_squares"),
        F.sum(F.when(drawn, F.col("_w") * F.abs(error))).alias("_sizes"),
    )
    sums = sums.where("n > 0")
    return sums.select(*keys, "replicate", "n", F.sqrt(F.col("_squares") / F.col("n")).alias("rmse"), (F.col("_sizes") / F.col("n")).alias("mae"))


def bootstrap_intervals(
    predictions: DataFrame,
    keys: Sequence[str] = ("model",),
    replicates: int = 200,
    coverage: float = 0.9,
    seed: int = 42,
    idx: str = "idx",
) -> DataFrame:
    """(keys.., replicates, rmse_lower, rmse_median, rmse_upper, mae_lower, mae_median, mae_upper)."""
    tails = {"lower": (1 - coverage) / 2, "median": 0.5, "upper": (1 + coverage) / 2}
    found = bootstrap_scores(predictions, keys, replicates, seed, idx).groupBy(*keys)
    ends = [F.percentile(c, F.lit(p)).alias(f"{c}_{name}") for c in ("rmse", "mae") for name, p in tails.items()]
    return found.agg(F.count("*").alias("replicates"), *ends)


def prediction_intervals(
    fitted: DataFrame, scored: DataFrame, coverage: float = 0.9, predicted: str = "predicted"
) -> DataFrame:
    """Add ``lower`` and ``upper`` to ``scored`` from the residual quantiles of ``fitted``."""
    tails = [(1 - coverage) / 2, (1 + coverage) / 2]
    found = exact_quantiles(fitted, ["residual"], tails).collect()
    offset = {row["probability"]: row["value"] for row in found}
    return scored.withColumns(
        {
            "lower": F.col(predicted) + F.lit(offset[tails[0]]),
            "upper": F.col(predicted) + F.lit(offset[tails[1]]),
        }
    )

"""Forecasters on a price series: autoregression of differences, and window regression."""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from seriesmill.operators.encode import extremes
from seriesmill.operators.least_squares import fit_linear, predict_linear
from seriesmill.operators.order import BLOCK_ROWS, join_series, over_blocks
from seriesmill.operators.windows import lag_names, supervised_windows
from seriesmill.session import lookup


def change_names(lags: int) -> list[str]:
    return [f"change_{i}" for i in range(1, lags + 1)]


def change_lags(
    df: DataFrame,
    value: str,
    lags: int = 5,
    differences: int = 1,
    keys: Sequence[str] = (),
    idx: str = "idx",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``change`` (the differenced value) and its lags ``change_1`` .. ``change_<lags>``.

    They are null in the first rows of a series, where the past is too short.
    """

    def build(window: WindowSpec) -> dict[str, Column]:
        def level(step: int) -> Column:
            return F.lag(value, step).over(window) if step else F.col(value)

        def change(step: int) -> Column:
            total = level(step)
            for j in range(1, differences + 1):
                total = total + F.lit((-1) ** j * comb(differences, j)) * level(step + j)
            return total

        names = ["change", *change_names(lags)]
        return {name: change(step) for step, name in enumerate(names)}

    return over_blocks(
        df, build, back=lags + differences, keys=keys, idx=idx, block_rows=block_rows
    )


def fit_autoregression(
    changes: DataFrame, lags: int = 5, keys: Sequence[str] = (), fit_on: Column | None = None
) -> DataFrame:
    """(keys.., n, coefficients): conditional least squares of the change on its lags."""
    rows = changes if fit_on is None else changes.where(fit_on)
    return fit_linear(rows, change_names(lags), "change", keys, intercept=False)


def predict_autoregression(
    changes: DataFrame,
    model: DataFrame,
    value: str,
    lags: int = 5,
    keys: Sequence[str] = (),
    out: str = "predicted",
) -> DataFrame:
    """Add the one-step-ahead level: what earlier levels imply plus the predicted change."""
    scored = predict_linear(
        changes, model, change_names(lags), "_change", keys=keys, intercept=False
    )
    # value - change is the part of the level known from earlier rows
    level = F.col(value) - F.col("change") + F.col("_change")
    return scored.withColumn(out, level).drop("_change")


def fit_window_model(
    df: DataFrame,
    value: str,
    length: int = 12,
    fit_on: Column | None = None,
    keys: Sequence[str] = (),
    idx: str = "idx",
) -> DataFrame:
    """(keys.., n, coefficients, low, high): regression of a value on the ``length`` before it.

    Each series is min-max scaled by its own extremes in the rows where ``fit_on`` holds, and has its
    own coefficients.
    """
    if keys:
        seen = df if fit_on is None else df.where(fit_on)
        bounds = lookup(seen.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high")))
        rows = _scaled_windows(join_series(df, bounds, keys), value, length, keys, idx)
        rows = rows if fit_on is None else rows.where(fit_on)
        fitted = join_series(fit_linear(rows, lag_names(length), "_scaled", keys), bounds, keys)
        return fitted.withColumnsRenamed({"_low": "low", "_high": "high"})
    low, high = extremes(df, value, fit_on)
    rows = df.withColumns({"_low": F.lit(low), "_high": F.lit(high)})
    rows = _scaled_windows(rows, value, length, keys, idx)
    rows = rows if fit_on is None else rows.where(fit_on)
    fitted = fit_linear(rows, lag_names(length), "_scaled", keys)
    return fitted.withColumns({"low": F.lit(low), "high": F.lit(high)})


def predict_window_model(
    df: DataFrame,
    model: DataFrame,
    value: str,
    length: int = 12,
    keys: Sequence[str] = (),
    idx: str = "idx",
    out: str = "predicted",
) -> DataFrame:
    """Add the prediction in the unit of ``value``; rows without a full window are dropped."""
    if keys:
        bounds = model.select(*keys, F.col("low").alias("_low"), F.col("high").alias("_high"))
        scaled = join_series(df, lookup(bounds), keys)
    else:
        scale = model.select("low", "high").first()
        low, high = (scale["low"], scale["high"]) if scale else (0.0, 1.0)
        scaled = df.withColumns({"_low": F.lit(low), "_high": F.lit(high)})
    rows = _scaled_windows(scaled, value, length, keys, idx)
    scored = predict_linear(rows, model, lag_names(length), "_guess", keys=keys)
    restored = F.col("_guess") * _range() + F.col("_low")
    return scored.withColumn(out, restored).drop("_scaled", "_guess", "_low", "_high", *lag_names(length))


def _range() -> Column:
    """Extent of a series; 1 for a constant one."""
    extent = F.col("_high") - F.col("_low")
    return F.when(extent == 0, 1.0).otherwise(extent)


def _scaled_windows(df, value, length, keys, idx) -> DataFrame:
    scaled = df.withColumn("_scaled", (F.col(value) - F.col("_low")) / _range())
    return supervised_windows(scaled, ["_scaled"], length, idx=idx, keys=keys)


def early_part(
    df: DataFrame, share: float = 0.9, keys: Sequence[str] = (), idx: str = "idx"
) -> DataFrame:
    """Add ``split``: 'train' for the first ``share`` of each series, 'val' for the rest."""
    if not keys:
        early = F.col(idx) < int(df.count() * share)
        return df.withColumn("split", F.when(early, "train").otherwise("val"))
    place = df.groupBy(*keys).agg(F.min(idx).alias("_first"), F.count(F.lit(1)).alias("_n"))
    early = F.col(idx) - F.col("_first") < F.floor(F.col("_n") * share)
    return (
        join_series(df, lookup(place), keys)
        .withColumn("split", F.when(early, "train").otherwise("val"))
        .drop("_first", "_n")
    )


def window_forecast(
    df: DataFrame,
    value: str = "price",
    length: int = 12,
    train_share: float = 0.9,
    keys: Sequence[str] = (),
    idx: str = "idx",
) -> DataFrame:
    """Fit a window model on the first ``train_share`` of each series and predict all of it.

    Adds (split, actual, predicted); the first ``length`` rows of a series are left out.
    """
    rows = early_part(df, train_share, keys, idx)
    model = fit_window_model(rows, value, length, F.col("split") == "train", keys, idx)
    scored = predict_window_model(rows, model, value, length, keys, idx)
    return scored.withColumn("actual", F.col(value))


def autocorrelation(
    df: DataFrame, value: str, lags: int, idx: str = "idx", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(lag, acf): sums of lagged products of the centred series over its sum of squares."""
    centre = df.agg(F.avg(value)).scalar()
    centred = df.withColumn("_x", F.col(value) - centre)

    def build(window: WindowSpec) -> dict[str, Column]:
        return {f"_x{k}": F.lag("_x", k).over(window) for k in range(1, lags + 1)}

    rows = over_blocks(centred, build, back=lags, idx=idx, block_rows=block_rows)
    total = F.sum(F.col("_x") * F.col("_x"))
    packed = [
        F.struct(
            F.lit(k).alias("lag"),
            F.try_divide(F.sum(F.col("_x") * F.col(f"_x{k}")), total).alias("acf"),
        )
        for k in range(1, lags + 1)
    ]
    return rows.agg(F.array(*packed).alias("_all")).select(F.inline("_all"))


def unit_root_statistic(
    df: DataFrame, value: str, idx: str = "idx", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row (n, gamma, t): Dickey-Fuller regression of the change on the level before it.

    Regression with a constant and no lagged changes; a t below about -2.86 rejects a
    unit root at five percent in long series.
    """
    rows = over_blocks(
        df,
        lambda window: {"_before": F.lag(value, 1).over(window)},
        back=1,
        idx=idx,
        block_rows=block_rows,
    ).where(F.col("_before").isNotNull() & F.col(value).isNotNull())
    change = F.col(value) - F.col("_before")
    level = F.col("_before")
    n = F.count(F.lit(1))
    sums = rows.agg(
        n.alias("n"),
        F.covar_pop(change, level).alias("cov"),
        F.var_pop(level).alias("level_var"),
        F.var_pop(change).alias("change_var"),
    )
    gamma = F.try_divide(F.col("cov"), F.col("level_var"))
    rest = F.col("n") * (F.col("change_var") - gamma * F.col("cov"))
    error = F.sqrt(F.try_divide(rest / (F.col("n") - 2), F.col("n") * F.col("level_var")))
    return sums.where(F.col("n") > 2).select(
        "n", gamma.alias("gamma"), F.try_divide(gamma, error).alias("t")
    )

"""Batch jobs: preprocess, train, evaluate and error report.

    python -m seriesmill.plans.jobs preprocess --input raw.csv --output engineered
    python -m seriesmill.plans.jobs train      --input engineered --models models
    python -m seriesmill.plans.jobs evaluate   --input engineered --models models
    python -m seriesmill.plans.jobs errors     --input engineered --models models
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.columns import numeric_columns, right_closed_bin
from seriesmill.operators import aggregates, features, forecast, learn, metrics, order, splits
from seriesmill.operators.features import PRICE_FEATURES, FeatureSpec
from seriesmill.session import build_session, stage
from seriesmill.sources.files import FILE_ORDER, PRICE_SCHEMA, read_csv, write_table
from seriesmill.sources.publish import read_published

LAGS, WINDOW = 5, 12
#: Models of single rows: least squares and boosted trees.
ROW_MODELS = ("linear", "trees")
RAIN_EDGES = [0, 100, 200, 300]
RAIN_LABELS = ["Low (<100mm)", "Mid (100-200mm)", "High (>200mm)"]


def preprocess(
    spark: SparkSession,
    source: str,
    target: str,
    order_by: Sequence[str] = (),
    fit_on_all: bool = False,
    test_fraction: float = 0.2,
    kind: str = "parquet",
    spec: FeatureSpec = PRICE_FEATURES,
    schema: T.StructType = PRICE_SCHEMA,
) -> DataFrame:
    """CSV of ``schema`` in, engineered table out; returns the written table.

    The output replaces an earlier one only when it is whole. Rows are ordered by ``order_by``, or as they stand in the file. The position is
    kept as ``idx``. Means for nulls come from the training part unless ``fit_on_all``.
    """
    raw = read_csv(spark, source, schema, file_order=not order_by)
    placed = order.with_position(raw, order_by or FILE_ORDER).drop(*FILE_ORDER)
    cut = splits.cut_position(placed.count(), test_fraction)
    fit_on = None if fit_on_all else F.col("idx") < cut
    made = splits.compact_position(features.engineer(placed, spec, fit_on))
    write_table(made, target, kind)
    return read_published(spark, target, made.schema)


@dataclass(frozen=True)
class Inputs:
    """Engineered rows and the monthly series, each with ``split`` and its first test position.

    Filters use the position itself, which reaches the parquet scan.
    """

    rows: DataFrame
    numeric: list[str]
    cut: int
    months: DataFrame
    month_cut: int


def _inputs(spark: SparkSession, path: str, spec: FeatureSpec, fraction: float) -> Inputs:
    rows = read_published(spark, path)
    months = aggregates.monthly_mean(rows, spec.target, spec.year, spec.month)
    months = order.with_position(months, ["month_start"])
    return Inputs(
        rows=splits.temporal_split(rows, fraction),
        numeric=numeric_columns(rows, exclude=(spec.target, *spec.not_features)),
        cut=splits.cut_position(rows.count(), fraction),
        months=splits.temporal_split(months, fraction),
        month_cut=splits.cut_position(months.count(), fraction),
    )


def train(
    spark: SparkSession,
    source: str,
    models: str,
    spec: FeatureSpec = PRICE_FEATURES,
    rounds: int = 100,
    folds: int = 5,
    fit_on_all: bool = False,
    test_fraction: float = 0.2,
    row_models: Sequence[str] = ROW_MODELS,
) -> DataFrame:
    """Fit and save the monthly models and ``row_models``; returns the cross-validation scores of the trees per fold.

    Models see the training part only. ``fit_on_all`` fits them on every row, test
    rows included, for comparison with results obtained that way.
    """
    given = _inputs(spark, source, spec, test_fraction)
    early = None if fit_on_all else F.col("idx") < given.cut
    early_months = None if fit_on_all else F.col("idx") < given.month_cut
    changes = forecast.change_lags(given.months, "price", LAGS)
    auto = forecast.fit_autoregression(changes, LAGS, fit_on=early_months)
    write_table(auto, f"{models}/autoregression")
    window = forecast.fit_window_model(given.months, "price", WINDOW, early_months)
    write_table(window, f"{models}/window")

    def trees():
        return learn.boosted_trees(spec.target, rounds)

    for name in row_models:
        regressor = learn.linear(spec.target) if name == "linear" else trees()
        fitted = learn.fit(given.rows, regressor, given.numeric, spec.category, early)
        learn.save(fitted, f"{models}/{name}")
    if not folds:
        columns = ["n long", *(f"{name} double" for name in ("rmse", "mae", "mape_pct", "r2"))]
        return spark.createDataFrame([], ", ".join(["fold int", *columns]))
    tested = learn.cross_validate(given.rows, trees, given.numeric, spec.category, folds)
    return metrics.regression_metrics(tested, ["fold"], actual=spec.target)


def evaluate(
    spark: SparkSession,
    source: str,
    models: str,
    spec: FeatureSpec = PRICE_FEATURES,
    whole_series: bool = False,
    test_fraction: float = 0.2,
    row_models: Sequence[str] = ROW_MODELS,
) -> DataFrame:
    """Comparison of the saved models: (model, grain, n, rmse, mae, mape_pct, r2).

    Scores are on the test part. ``whole_series`` scores the monthly models on all
    months, as a model fitted on all of them would be.
    """
    given = _inputs(spark, source, spec, test_fraction)
    late_months = F.lit(True) if whole_series else F.col("idx") >= given.month_cut
    late = given.rows.where(F.col("idx") >= given.cut)
    changes = forecast.change_lags(given.months, "price", LAGS)
    auto = forecast.predict_autoregression(
        changes, read_published(spark, f"{models}/autoregression"), "price", LAGS
    )
    window = forecast.predict_window_model(
        given.months, read_published(spark, f"{models}/window"), "price", WINDOW
    )
    parts = [
        metrics.as_predictions(found.where(late_months), name, "month", "price", "predicted")
        for name, found in (("autoregression(5,1,0)", auto), ("window(12)", window))
    ]
    for name in row_models:
        scored = learn.score(learn.load(f"{models}/{name}"), late)
        parts.append(metrics.as_predictions(scored, name, "row", spec.target, "predicted"))
    return metrics.compare_models(parts).orderBy("rmse")


def error_report(
    spark: SparkSession,
    source: str,
    models: str,
    spec: FeatureSpec = PRICE_FEATURES,
    bin_by: str = "Rainfall",
    edges: Sequence[float] = RAIN_EDGES,
    labels: Sequence[str] = RAIN_LABELS,
    show: Sequence[str] = (),
    k: int = 20,
    test_fraction: float = 0.2,
    model: str = "trees",
) -> dict[str, DataFrame]:
    """Tables on where a saved model (the trees, or ``linear``) fails, over all rows: residuals, worst rows, error by bin, features."""
    rows = splits.temporal_split(read_published(spark, source), test_fraction)
    fitted = learn.load(f"{models}/{model}")
    scored = metrics.with_errors(learn.score(fitted, rows), spec.target)
    scored = stage(
        scored.withColumn("bin", right_closed_bin(F.col(bin_by), edges, labels)), "scored"
    )
    columns = list(show) or [c for c in scored.columns if c not in spec.made]
    return {
        "residuals": metrics.residual_summary(scored),
        "residuals_by_split": metrics.regression_metrics(scored, ["split"], actual=spec.target),
        "worst": metrics.worst_predictions(scored, k).select(*columns),
        "error_by_bin": aggregates.mean_by_bin(scored, "bin", "abs_error"),
        "features": learn.top_features(learn.importance(fitted, rows), 15),
    }


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="seriesmill")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("preprocess", "train", "evaluate", "errors"):
        command = commands.add_parser(name)
        command.add_argument("--input", required=True)
        command.add_argument("--output" if name == "preprocess" else "--models", required=True)
        command.add_argument("--test-fraction", type=float, default=0.2)
        if name in ("preprocess", "train"):
            command.add_argument("--fit-on-all", action="store_true")
        if name == "preprocess":
            command.add_argument("--order-by", nargs="*", default=[])
            command.add_argument("--kind", choices=["parquet", "csv"], default="parquet")
        if name == "train":
            command.add_argument("--rounds", type=int, default=100)
            command.add_argument("--folds", type=int, default=5)
        if name == "evaluate":
            command.add_argument("--whole-series", action="store_true")
    given = vars(parser.parse_args(arguments))
    command, source = given.pop("command"), given.pop("input")
    place = given.pop("output", None) or given.pop("models", None)
    spark = build_session()
    if command == "preprocess":
        made = preprocess(spark, source, place, **given)
        print(f"{made.count()} rows, {len(made.columns)} columns in {place}")
    elif command == "errors":
        for title, table in error_report(spark, source, place, **given).items():
            print(title)
            table.show(20, truncate=False)
    else:
        {"train": train, "evaluate": evaluate}[command](spark, source, place, **given).show()


if __name__ == "__main__":
    main()

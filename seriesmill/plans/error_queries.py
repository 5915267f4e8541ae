"""Registered queries: metrics and error reports on predictors that need no fitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.functions.columns import right_closed_bin
from seriesmill.operators import aggregates, metrics, splits
from seriesmill.plans.check_sql import given
from seriesmill.plans.inputs import fixed_predictions, ordered, rounded
from seriesmill.plans.registry import query
from seriesmill.session import lookup

SCORES = ["rmse", "mae", "mape_pct", "r2"]
_SCORES_SQL = """round(sqrt(avg((actual - predicted) * (actual - predicted))), 6) AS rmse,
    round(avg(abs(actual - predicted)), 6) AS mae,
    round(avg(abs(actual - predicted) / greatest(abs(actual), 2.220446049250313e-16)) * 100, 6)
      AS mape_pct,
    round(1 - sum((actual - predicted) * (actual - predicted))
      / (var_pop(actual) * count(*)), 6) AS r2"""


@query(
    "E7",
    given("predicted", f"SELECT model, count(*) AS n, {_SCORES_SQL} FROM predicted GROUP BY model"),
)
def regression_scores(spark, folder):
    return rounded(metrics.regression_metrics(fixed_predictions(spark, folder)), SCORES)


@query(
    "E8 C8",
    given(
        "scored",
        """SELECT model, 'row' AS grain, n, round_even(rmse, 4) AS rmse, round_even(mae, 4) AS mae,
                  round_even(mape_pct, 2) AS mape_pct, round_even(r2, 4) AS r2 FROM scored""",
    ),
)
def model_comparison(spark, folder):
    rows = fixed_predictions(spark, folder).withColumn("grain", F.lit("row"))
    return metrics.compare_models([rows])


@query(
    "E9 C11",
    given(
        "predicted",
        """SELECT model, round(avg(actual - predicted), 6) AS mean,
                  round(stddev_pop(actual - predicted), 6) AS std,
                  round(min(actual - predicted), 6) AS min, round(max(actual - predicted), 6) AS max
           FROM predicted WHERE model = 'previous' GROUP BY model""",
    ),
)
def residual_report(spark, folder):
    rows = metrics.with_errors(fixed_predictions(spark, folder)).where(F.col("model") == "previous")
    found = metrics.residual_summary(rows).select(F.lit("previous").alias("model"), "*")
    return rounded(found, ["mean", "std", "min", "max"])


@query(
    "C11",
    given(
        "predicted",
        """SELECT obs_id, round(actual - predicted, 4) AS residual,
                  round(abs(actual - predicted), 4) AS abs_error
           FROM predicted WHERE model = 'previous'""",
    ),
)
def residual_columns(spark, folder):
    rows = metrics.with_errors(fixed_predictions(spark, folder)).where(F.col("model") == "previous")
    made = ["residual", "abs_error"]
    return rounded(rows.select("obs_id", *made), made, 4)


@query(
    "F3",
    given(
        "predicted",
        """SELECT idx, year, month, day, season, qty, actual, round(predicted, 4) AS predicted,
                  round(abs(actual - predicted), 4) AS abs_error
           FROM predicted WHERE model = 'previous'
           ORDER BY round(abs(actual - predicted), 4) DESC, idx LIMIT 20""",
    ),
)
def worst_twenty(spark, folder):
    carry = ["year", "month", "day", "season", "qty"]
    rows = fixed_predictions(spark, folder, carry).where(F.col("model") == "previous")
    rows = rounded(metrics.with_errors(rows), ["predicted", "abs_error"], 4)
    return metrics.worst_predictions(rows).select("idx", *carry, "actual", "predicted", "abs_error")


@query(
    "E4 C10",
    given(
        "predicted",
        """+ binned AS (SELECT abs(actual - predicted) AS e,
             CASE WHEN qty > 0 AND qty <= 100 THEN 'Low (<100)'
                  WHEN qty > 100 AND qty <= 200 THEN 'Mid (100-200)'
                  WHEN qty > 200 AND qty <= 300 THEN 'High (>200)' END AS qty_group
           FROM predicted WHERE model = 'previous')
        SELECT qty_group, count(*) AS n, round(avg(e), 6) AS mean_abs_error
        FROM binned WHERE qty_group IS NOT NULL GROUP BY qty_group""",
    ),
)
def error_by_quantity(spark, folder):
    rows = fixed_predictions(spark, folder, ["qty"]).where(F.col("model") == "previous")
    labels = ["Low (<100)", "Mid (100-200)", "High (>200)"]
    group = right_closed_bin(F.col("qty"), [0, 100, 200, 300], labels)
    binned = metrics.with_errors(rows).withColumn("qty_group", group)
    return rounded(aggregates.mean_by_bin(binned, "qty_group", "abs_error"), ["mean_abs_error"])


@query(
    "E10 D8",
    given(
        "ord",
        """+ s AS (SELECT count(*) AS n, count(*) // 6 AS size FROM ord),
        f AS (SELECT k AS fold, n - (6 - k) * size AS a, n - (5 - k) * size AS b
              FROM (SELECT unnest([1, 2, 3, 4, 5]) AS k), s),
        means AS (SELECT fold, avg(price) AS guess FROM ord JOIN f ON idx < a GROUP BY fold),
        per_fold AS (SELECT f.fold, sqrt(avg((price - guess) * (price - guess))) AS rmse
                     FROM ord JOIN f ON idx >= a AND idx < b JOIN means m ON m.fold = f.fold
                     GROUP BY f.fold)
        SELECT count(*) AS folds, round(avg(rmse), 6) AS mean_rmse,
               round(stddev_pop(rmse), 6) AS std_rmse FROM per_fold""",
    ),
)
def fold_score_summary(spark, folder):
    rows = ordered(spark, folder, ["price"])
    size = rows.count()
    sums = {"total": ("sum", F.col("price")), "known": ("sum", F.col("price").isNotNull().cast("long"))}
    trained = splits.fold_aggregates(rows, sums, rows=size).where(F.col("role") == "train")
    guess = trained.select("fold", F.try_divide("total", "known").alias("predicted"))
    fold = splits.fold_segment(splits.fold_bounds(size))
    tested = rows.withColumn("fold", fold).where("fold > 0").join(lookup(guess), "fold")
    per_fold = metrics.regression_metrics(tested, ["fold"], actual="price")
    return rounded(metrics.fold_summary(per_fold), ["mean_rmse", "std_rmse"])


@query(
    "E11",
    given(
        "predicted",
        """+ s AS (SELECT model, split, sqrt(avg((actual - predicted) * (actual - predicted))) AS r
                   FROM predicted GROUP BY model, split)
        SELECT model, round(max(CASE WHEN split = 'train' THEN r END), 6) AS train_rmse,
               round(max(CASE WHEN split = 'test' THEN r END), 6) AS test_rmse,
               round(max(CASE WHEN split = 'test' THEN r END)
                     - max(CASE WHEN split = 'train' THEN r END), 6) AS gap
        FROM s GROUP BY model""",
    ),
)
def train_test_gap(spark, folder):
    per_split = metrics.regression_metrics(fixed_predictions(spark, folder), ["model", "split"])
    return rounded(metrics.generalisation_gap(per_split), ["train_rmse", "test_rmse", "gap"])


LEVELS = [50_000, 100_000, 250_000, 450_000]


@query(
    "E13",
    given(
        "scored",
        """SELECT model, round(rmse, 6) AS rmse, level, round(rmse / level * 100, 6) AS error_pct
           FROM scored, (SELECT unnest([50000.0::DOUBLE, 100000.0::DOUBLE, 250000.0::DOUBLE,
                                        450000.0::DOUBLE]) AS level)""",
    ),
)
def error_by_price_level(spark, folder):
    found = metrics.regression_metrics(fixed_predictions(spark, folder)).select("model", "rmse")
    return rounded(metrics.error_by_level(found, LEVELS), ["rmse", "error_pct"])


@query(
    "E14",
    given(
        "scored",
        """SELECT model, round(rmse, 6) AS rmse, round((b.base - rmse) / b.base * 100, 6)
                  AS improvement_pct
           FROM scored, (SELECT rmse AS base FROM scored WHERE model = 'previous') b""",
    ),
)
def improvement_over_previous(spark, folder):
    found = metrics.regression_metrics(fixed_predictions(spark, folder)).select("model", "rmse")
    return rounded(metrics.improvement_over(found, "previous"), ["rmse", "improvement_pct"])


@query(
    "P8",
    given(
        "predicted",
        """+ q AS (SELECT quantile_cont(actual - predicted, 0.05) AS lo,
                          quantile_cont(actual - predicted, 0.95) AS hi
                   FROM predicted WHERE model = 'previous' AND split = 'train')
        SELECT idx, round(predicted + lo, 4) AS lower, round(predicted + hi, 4) AS upper
        FROM predicted, q WHERE model = 'previous' AND split = 'test'""",
    ),
)
def price_intervals(spark, folder):
    rows = metrics.with_errors(fixed_predictions(spark, folder)).where(F.col("model") == "previous")
    train, test = (rows.where(F.col("split") == s) for s in ("train", "test"))
    found = metrics.prediction_intervals(train, test, 0.9)
    return rounded(found.select("idx", "lower", "upper"), ["lower", "upper"], 4)


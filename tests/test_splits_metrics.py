import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import encode, metrics, splits


def test_temporal_split(series):
    frame = splits.temporal_split(series(x=list(range(10))))
    train = [r["idx"] for r in frame.where("split = 'train'").collect()]
    assert sorted(train) == list(range(8))
    check = splits.leakage_check(frame).first()
    assert (check["train_rows"], check["test_rows"], check["in_order"], check["sizes_ok"]) == (8, 2, True, True)


def test_leak_is_noticed(series):
    frame = splits.random_split(series(x=list(range(200))))
    assert splits.leakage_check(frame).first()["in_order"] is False


def test_fold_bounds():
    bounds = splits.fold_bounds(1000, 5)
    assert [b[1] for b in bounds] == [170, 336, 502, 668, 834]
    assert {b[2] - b[1] for b in bounds} == {166}
    with pytest.raises(ValueError):
        splits.fold_bounds(4, 5)


def test_expanding_folds(series):
    found = splits.expanding_folds(series(x=list(range(14))), 3)
    counts = {(r["fold"], r["role"]): r["count"] for r in found.groupBy("fold", "role").count().collect()}
    assert counts == {(1, "train"): 5, (1, "test"): 3, (2, "train"): 8, (2, "test"): 3,
                      (3, "train"): 11, (3, "test"): 3}


def test_overlap_split(series):
    from seriesmill.operators.windows import supervised_windows

    made = splits.split_by_target(supervised_windows(series(x=list(range(80))), ["x"], 12), 80)
    assert {r["split"]: r["count"] for r in made.groupBy("split").count().collect()} == {
        "train": 60, "val": 8}


def test_compact_position(series):
    frame = series(x=list(range(10))).where("idx % 3 != 0")
    found = splits.compact_position(frame).orderBy("idx").collect()
    assert [r["idx"] for r in found] == list(range(6))
    assert [r["x"] for r in found] == [1, 2, 4, 5, 7, 8]


def test_oversample(series):
    found = splits.oversample(series(x=[1, 5, 10]), "x", 2, 9, 3)
    assert sorted(r["x"] for r in found.collect()) == [1, 1, 1, 5, 10, 10, 10]


def scores(series, actual, predicted):
    return metrics.regression_metrics(series(actual=actual, predicted=predicted), []).first()


def test_metric_identities(series):
    y = [1, 2, 3, 4, 5]
    assert scores(series, y, y)["r2"] == 1
    assert scores(series, y, [3] * 5)["r2"] == pytest.approx(0, abs=1e-12)
    assert scores(series, [1, 2, 3], [1.1, 2.1, 3.1])["rmse"] == pytest.approx(0.1)


def test_metric_edge_cases(series):
    assert scores(series, [4, 4], [4, 4])["r2"] == 1
    assert scores(series, [4, 4], [4, 5])["r2"] == 0
    assert scores(series, [4], [5])["r2"] is None
    assert scores(series, [0, 1], [1, 1])["mape_pct"] == pytest.approx(50 / metrics.EPSILON)
    missing = scores(series, [1, 2, 3], [None, 2, 5])
    assert missing["n"] == 2 and missing["mae"] == 1


def test_metrics_against_arrays(series):
    random = np.random.default_rng(0)
    y, p = random.uniform(1, 9, 300), random.uniform(1, 9, 300)
    found = scores(series, list(map(float, y)), list(map(float, p)))
    assert found["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert found["mae"] == pytest.approx(np.mean(abs(y - p)))
    assert found["mape_pct"] == pytest.approx(np.mean(abs(y - p) / y) * 100)
    assert found["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_worst_keeps_first_of_ties(series):
    frame = series(abs_error=[1, 3, 3, 2])
    assert [r["idx"] for r in metrics.worst_predictions(frame, 2).collect()] == [1, 2]


def test_comparison_and_improvement(series):
    rows = series(y=[1, 2, 3, 4], p=[2, 3, 4, 5], q=[1.5, 2.5, 3.5, 4.5])
    made = [metrics.as_predictions(rows, name, "row", "y", c) for name, c in (("far", "p"), ("near", "q"))]
    table = metrics.compare_models(made)
    found = {r["model"]: r for r in metrics.improvement_over(table, "far").collect()}
    assert found["near"]["rmse"] == 0.5 and found["near"]["improvement_pct"] == 50
    assert found["far"]["improvement_pct"] == 0
    levels = metrics.error_by_level(table, [1.5, 3.0]).where("model = 'near'").collect()
    assert [r["error_pct"] for r in levels] == [pytest.approx(100 / 3), pytest.approx(50 / 3)]


def test_residual_summary_uses_population_deviation(series):
    found = metrics.residual_summary(metrics.with_errors(series(actual=[1, 2], predicted=[0, 3]))).first()
    assert (found["mean"], found["std"], found["min"], found["max"]) == (0, 1, -1, 1)


def test_intervals(series):
    fitted = metrics.with_errors(series(actual=list(range(101)), predicted=[50] * 101))
    found = metrics.prediction_intervals(fitted, series(predicted=[10.0]), 0.9).first()
    assert found["lower"] == pytest.approx(10 - 45) and found["upper"] == pytest.approx(10 + 45)


def test_constant_column_scaling(series):
    frame = series(x=[3, 3, 3])
    assert {r["x"] for r in encode.standardised(frame, ["x"]).collect()} == {0}
    low, high = encode.extremes(frame, "x")
    scaled = frame.select(encode.min_max_scaled(F.col("x"), low, high).alias("s"))
    assert {r["s"] for r in scaled.collect()} == {0}


def test_scaling_does_not_clip_and_inverts(series):
    low, high = encode.extremes(series(x=[0, 10, 20]), "x", F.col("idx") < 2)
    scaled = encode.min_max_scaled(F.col("x"), low, high)
    frame = series(x=[0, 10, 20]).select("idx", scaled.alias("s"),
                                         encode.min_max_restored(scaled, low, high).alias("x"))
    found = frame.orderBy("idx").collect()
    assert [r["s"] for r in found] == [0, 1, 2] and [r["x"] for r in found] == [0, 10, 20]


def test_one_hot(series):
    frame = series(s=["Winter", "Autumn", "Spring", "Summer"])
    found = encode.one_hot(frame, "s").orderBy("idx").collect()
    dummies = ["s_Spring", "s_Summer", "s_Winter"]
    assert [[r[d] for d in dummies] for r in found] == [[0, 0, 1], [0, 0, 0], [1, 0, 0], [0, 1, 0]]


def test_one_hot_unknown_is_an_error(series):
    frame = series(s=["a", "b", "z"])
    with pytest.raises(Exception, match="unknown s: z"):
        encode.one_hot(frame, "s", ["a", "b"]).collect()
    ignored = encode.one_hot(frame, "s", ["a", "b"], unknown="ignore").orderBy("idx").collect()
    assert [r["s_b"] for r in ignored] == [0, 1, 0]


def test_too_many_categories(series):
    with pytest.raises(ValueError):
        encode.categories(series(s=["a", "b", "c"]), "s", limit=2)


def test_label_codes(series):
    found = encode.label_codes(series(s=["b", "a", "c"]), "s", "code").orderBy("idx").collect()
    assert [r["code"] for r in found] == [1, 0, 2]


def test_fold_aggregates_equal_copied_folds(series):
    rows = series(x=[float(v * v % 7) for v in range(23)])
    wanted = {"rows": ("sum", F.lit(1)), "total": ("sum", F.col("x")), "low": ("min", F.col("x")), "high": ("max", F.col("x"))}
    found = splits.fold_aggregates(rows, wanted, 4).select("fold", "role", "rows", "total", "low", "high")
    copied = splits.expanding_folds(rows, 4).groupBy("fold", "role").agg(
        F.count("*").alias("rows"), F.sum("x").alias("total"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    assert sorted(found.collect()) == sorted(copied.collect()) and found.count() == 8
    with pytest.raises(ValueError):
        splits.fold_aggregates(rows.limit(0), wanted, 4)

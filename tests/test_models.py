import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SMALL
from seriesmill.operators import forecast, learn, least_squares, metrics, order
from seriesmill.plans import jobs
from seriesmill.plans.model_queries import DRIVERS, _spend_rows
from seriesmill.sources.files import read_csv


@pytest.fixture(scope="module")
def spend(spark):
    return _spend_rows(spark, SMALL)


def test_autoregression_recovers_its_coefficients(series):
    phi = np.array([-0.6, -0.4, -0.3, -0.2, -0.1])
    random = np.random.default_rng(11)
    change = np.zeros(20_000)
    for t in range(5, len(change)):
        change[t] = phi @ change[t - 5 : t][::-1] + random.normal()
    rows = forecast.change_lags(series(x=list(map(float, change.cumsum()))), "x", 5)
    found = forecast.fit_autoregression(rows, 5).first()
    assert found["n"] == len(change) - 6
    np.testing.assert_allclose(found["coefficients"], phi, atol=0.03)


@pytest.mark.parametrize("block_rows", [8, 100_000])
def test_autoregression_against_arrays(series, block_rows):
    x = np.random.default_rng(4).normal(size=80).cumsum()
    d = np.diff(x)
    past = np.column_stack([d[4 - k : len(d) - 1 - k] for k in range(5)])
    expected, *_ = np.linalg.lstsq(past, d[5:], rcond=None)
    rows = forecast.change_lags(series(x=list(map(float, x))), "x", 5, block_rows=block_rows)
    model = forecast.fit_autoregression(rows, 5)
    np.testing.assert_allclose(model.first()["coefficients"], expected, rtol=1e-8)
    scored = forecast.predict_autoregression(rows, model, "x", 5).orderBy("idx").collect()
    assert [r["predicted"] for r in scored[:6]] == [None] * 6
    np.testing.assert_allclose([r["predicted"] for r in scored[6:]], x[5:-1] + past @ expected)


def test_many_series_with_a_hot_and_a_short_one(spark):
    random = np.random.default_rng(9)
    parts = [("hot", 500), ("b", 40), ("short", 3)]
    pdf = pd.concat([pd.DataFrame({"key": k, "t": range(n), "x": random.normal(size=n).cumsum()})
                     for k, n in parts])
    placed = order.with_position(spark.createDataFrame(pdf), ["key", "t"])
    rows = forecast.change_lags(placed, "x", 2, keys=["key"], block_rows=10)
    model = forecast.fit_autoregression(rows, 2, ["key"])
    found = {r["key"]: r["coefficients"] for r in model.collect()}
    assert set(found) == {"hot", "b"}
    for key in found:
        d = np.diff(pdf[pdf["key"] == key]["x"])
        expected, *_ = np.linalg.lstsq(np.column_stack([d[1:-1], d[:-2]]), d[2:], rcond=None)
        np.testing.assert_allclose(found[key], expected, rtol=1e-8)
    scored = forecast.predict_autoregression(rows, model, "x", 2, ["key"])
    assert scored.count() == len(pdf)
    assert scored.where("predicted is not null").count() == (500 - 3) + (40 - 3)


def test_window_model(series):
    x = np.sin(np.arange(120) / 3) + np.random.default_rng(0).normal(0, 0.01, 120)
    made = forecast.window_forecast(series(price=list(map(float, x))), length=12)
    assert made.count() == 108
    assert {r["split"]: r["count"] for r in made.groupBy("split").count().collect()} == {"train": 96, "val": 12}
    assert metrics.regression_metrics(made.where("split = 'val'"), []).first()["r2"] > 0.95


def test_autocorrelation(series):
    x = np.random.default_rng(3).normal(size=200).cumsum()
    found = forecast.autocorrelation(series(x=list(map(float, x))), "x", 3, block_rows=7)
    c = x - x.mean()
    for row in found.collect():
        k = row["lag"]
        assert row["acf"] == pytest.approx((c[k:] * c[:-k]).sum() / (c * c).sum())


def test_unit_root(series):
    random = np.random.default_rng(8)
    noise, walk = random.normal(size=500), random.normal(size=500).cumsum()
    t = {name: forecast.unit_root_statistic(series(x=list(map(float, x))), "x").first()["t"]
         for name, x in (("noise", noise), ("walk", walk))}
    assert t["noise"] < -15 and t["walk"] > -3.4


def test_least_squares_with_intercept(series):
    random = np.random.default_rng(6)
    a, b = random.normal(size=100), random.normal(size=100)
    frame = series(a=list(map(float, a)), b=list(map(float, b)), y=list(map(float, 3 * a - 2 * b + 7)))
    model = least_squares.fit_linear(frame, ["a", "b"], "y")
    np.testing.assert_allclose(model.first()["coefficients"], [3, -2, 7], rtol=1e-9)


def test_pipeline_scales_and_drops_the_first_season(spark, spend):
    model = learn.fit(spend, learn.linear("spend"), DRIVERS, "season")
    names = learn.feature_names(model)
    assert names[:3] == ["cat__season_Winter", "cat__season_Summer", "cat__season_Spring"]
    assert len(names) == len(DRIVERS) + 3
    features = model.transform(spend).select("season", vector_to_array("features").alias("f"))
    autumn = features.where("season = 'Autumn'").first()["f"]
    assert autumn[:3] == [0, 0, 0]
    z = features.select(F.avg(F.col("f")[3]), F.stddev_pop(F.col("f")[3])).first()
    assert z[0] == pytest.approx(0, abs=1e-9) and z[1] == pytest.approx(1, abs=1e-9)


def test_unknown_season_is_an_error(spark, spend):
    model = learn.fit(spend, learn.linear("spend"), ["qty"], "season")
    with pytest.raises(Exception, match="Unseen label"):
        learn.score(model, spend.withColumn("season", F.lit("Monsoon"))).collect()


@pytest.mark.parametrize("kind", ["linear", "trees"])
def test_models_explain_spend_and_survive_saving(spark, spend, tmp_path, kind):
    regressor = learn.linear("spend") if kind == "linear" else learn.boosted_trees("spend", 20)
    model = learn.fit(spend, regressor, DRIVERS, "season", F.col("split") == "train")
    test = spend.where("split = 'test'")
    scored = learn.score(model, test)
    r2 = metrics.regression_metrics(scored, [], actual="spend").first()["r2"]
    assert r2 > 0.6
    learn.save(model, str(tmp_path / "m"))
    again = learn.score(learn.load(str(tmp_path / "m")), test)
    assert scored.select("obs_id", "predicted").exceptAll(again.select("obs_id", "predicted")).isEmpty()
    shares = learn.importance(model, spend)
    assert shares.agg(F.sum("pct")).first()[0] == pytest.approx(100)
    assert learn.top_features(shares, 3).count() == 3


def test_early_stopping(spark, series):
    random = np.random.default_rng(1)
    frame = series(x=list(map(float, random.normal(size=300))), y=list(map(float, random.normal(size=300))))
    frame = frame.withColumn("late", F.col("idx") >= 250)
    model = learn.fit(frame, learn.boosted_trees("y", 30, "late", validationTol=0.01), ["x"])
    assert model.stages[-1].getNumTrees < 30


@pytest.fixture(scope="module")
def files(spark, price_table, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    raw = price_table.copy()
    raw.loc[[3, 50, 690], "Rainfall"] = np.nan
    raw.loc[[10], "Season"] = None
    raw.to_csv(folder / "raw.csv", index=False)
    return str(folder), raw


def test_read_csv_keeps_file_order(spark, files):
    folder, raw = files
    frame = read_csv(spark, f"{folder}/raw.csv", file_order=True)
    found = order.with_position(frame, ["_file", "_file_offset", "_file_row"])
    found = found.orderBy("idx").select("Food_Price").toPandas()
    assert found["Food_Price"].tolist() == raw["Food_Price"].tolist()


def test_wrong_header_is_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "bad.csv")).collect()


def test_preprocess_equals_array_version(spark, files):
    folder, raw = files
    made = jobs.preprocess(spark, f"{folder}/raw.csv", f"{folder}/whole", fit_on_all=True)
    expected = raw.fillna(raw.mean(numeric_only=True))
    spec = jobs.PRICE_FEATURES
    made_of = {
        **{new: expected[old].shift(1).bfill() for new, old in spec.lags.items()},
        **{new: expected[old].rolling(3, min_periods=1).mean() for new, old in spec.rolling.items()},
        **{new: expected[old].diff().bfill() for new, old in spec.differences.items()},
        **{new: expected[a] * expected[b] for new, (a, b) in spec.products.items()},
    }
    expected = expected.assign(**made_of)
    expected = expected.dropna().reset_index(drop=True)
    found = made.toPandas().sort_values("idx").reset_index(drop=True)
    assert found["idx"].tolist() == list(range(len(raw) - 1))
    assert set(found.columns) == {*expected.columns, "idx"} and len(expected.columns) == 27
    pd.testing.assert_frame_equal(
        found[expected.columns], expected, check_dtype=False, rtol=1e-9, atol=1e-9
    )


def test_jobs_from_csv_to_report(spark, files):
    folder, raw = files
    made = jobs.preprocess(spark, f"{folder}/raw.csv", f"{folder}/engineered")
    train = raw.iloc[: int(len(raw) * 0.8)]
    filled = made.where("idx = 3").first()["Rainfall"]
    assert filled == pytest.approx(train["Rainfall"].mean())
    models = f"{folder}/models"
    folds = jobs.train(spark, f"{folder}/engineered", models, rounds=10, folds=2)
    assert folds.count() == 2
    table = {r["model"]: r for r in jobs.evaluate(spark, f"{folder}/engineered", models).collect()}
    assert set(table) == {"autoregression(5,1,0)", "window(12)", "linear", "trees"}
    assert table["linear"]["r2"] > 0.95 and table["trees"]["r2"] > 0.85
    assert table["linear"]["n"] == 140 and table["linear"]["grain"] == "row"
    whole = jobs.evaluate(spark, f"{folder}/engineered", models, whole_series=True)
    months = raw.dropna(subset=["Season"]).groupby(["Year", "Month"]).ngroups
    assert {r["model"]: r["n"] for r in whole.collect()}["window(12)"] == months - 12
    report = jobs.error_report(spark, f"{folder}/engineered", models)
    worst = [r["abs_error"] for r in report["worst"].collect()]
    assert len(worst) == 20 and worst == sorted(worst, reverse=True)
    assert report["error_by_bin"].count() == 3
    top = report["features"].first()["feature"]
    assert top == "Previous_Price"


def test_model_sees_28_features(spark, files):
    folder, _ = files
    given = jobs._inputs(spark, f"{folder}/engineered", jobs.PRICE_FEATURES, 0.2)
    model = learn.fit(given.rows, learn.linear("Food_Price"), given.numeric, "Season")
    assert len(learn.feature_names(model)) == 28


def test_csv_output_reads_back(spark, files):
    folder, _ = files
    made = jobs.preprocess(spark, f"{folder}/raw.csv", f"{folder}/out_csv", kind="csv")
    kept = spark.read.parquet(f"{folder}/engineered")
    assert made.count() == kept.count()
    assert made.select("idx", "Rainfall").exceptAll(kept.select("idx", "Rainfall")).isEmpty()

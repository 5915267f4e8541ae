"""Scale, null and NaN cases where a plain implementation goes wrong without saying so."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import aggregates, correlation, encode, forecast, learn, splits, windows
from seriesmill.operators.least_squares import fit_linear
from seriesmill.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("base", [0.0, 1e5, 1.7e9])
def test_offsets_do_not_cost_the_slope(spark, base):
    rows = [(base + i, 2.0 * i + 3) for i in range(1000)]
    found = fit_linear(spark.createDataFrame(rows, "x double, y double"), ["x"], "y").first()
    assert found["coefficients"][0] == pytest.approx(2.0, rel=1e-6)
    assert found["coefficients"][1] == pytest.approx(3 - 2 * base, rel=1e-6)


@pytest.mark.parametrize("intercept", [True, False])
def test_columns_of_different_size(spark, intercept):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3)) * [1e-6, 1.0, 1e6]
    y = x @ [3e6, -2.0, 5e-6] + (7 if intercept else 0) + rng.normal(size=500) * 0.1
    frame = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    found = fit_linear(frame, ["a", "b", "c"], "y", intercept=intercept).first()["coefficients"]
    full = np.column_stack([x, np.ones(500)]) if intercept else x
    assert found == pytest.approx(list(np.linalg.lstsq(full, y, rcond=None)[0]), rel=1e-6)


def test_series_of_different_size_are_forecast_alike(spark):
    rng = np.random.default_rng(3)
    shape = np.sin(np.arange(300) / 5) + rng.normal(size=300) * 0.05
    rows = [(i, k, float(shape[i] * size)) for k, size in (("a", 1.0), ("b", 1e6)) for i in range(300)]
    frame = spark.createDataFrame(rows, "idx long, k string, price double")
    found = forecast.window_forecast(frame, length=4, keys=["k"]).groupBy("k")
    error = {r["k"]: r["e"] for r in found.agg((F.avg(F.abs(F.expr("actual - predicted"))) / F.stddev("actual")).alias("e")).collect()}
    assert error["a"] == pytest.approx(error["b"], rel=1e-6) and error["a"] < 0.2


VALUES = {
    "plain": [3.0, 1.0, 2.0, 2.0, 5.0], "infinite": [1.0, 2.0, math.inf, -math.inf, 3.0], "wide": [-1e308, 1e308, 0.0, 1.0],
    "nan": [1.0, math.nan, 3.0, None], "none": [None, None], "constant": [4.0] * 6, "tiny": [0.0, 5e-324, 1e-323, 1.0],
}


def test_both_quantile_paths_agree(spark):
    rows = [(None if k == "plain" else k, v) for k, values in VALUES.items() for v in values]
    frame = spark.createDataFrame(rows, "k string, v double")
    seen = []
    for limit in (10**6, 2):
        found = exact_quantiles(frame, ["v"], [0.0, 0.25, 0.5, 1.0], ["k"], exact_rows=limit).collect()
        seen.append({(r["k"], r["probability"]): r["value"] for r in found})
    few, many = seen
    assert many.keys() == few.keys()
    for key in few:
        assert few[key] == many[key] or (few[key] is None and many[key] is None) or few[key] == pytest.approx(many[key], nan_ok=True)


def test_nan_is_unknown_for_any_number_of_columns(spark):
    rows = [(float(i), float(i * i), math.nan if i == 3 else float(-i), 1.0 * (i % 2), float(i % 3), float(i % 5)) for i in range(20)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double")
    wide = {r["column_name"]: r["corr"] for r in correlation.correlation_with(frame, "a", list("abcdef")).collect()}
    narrow = {r["column_name"]: r["corr"] for r in correlation.correlation_with(frame, "a", list("abc")).collect()}
    assert narrow["c"] == pytest.approx(wide["c"]) and narrow["c"] == pytest.approx(-1.0)


def test_months_of_a_null_key_stay(spark):
    frame = spark.createDataFrame([(None, 2020, 1, 5.0), (None, 2020, 3, 6.0), ("x", 2020, 1, 1.0)], "k string, year int, month int, price double")
    found = aggregates.monthly_mean(frame, "price", keys=["k"], fill_gaps=True).orderBy("k", "month_start").collect()
    assert [(r["k"], r["month_start"].month, r["price"], r["n"]) for r in found] == [(None, 1, 5.0, 1), (None, 2, None, 0), (None, 3, 6.0, 1), ("x", 1, 1.0, 1)]


def test_back_fill_after_nulls(series):
    frame = series(x=[1, None, None, 4, 6], y=[1, 2, 3, 4, 5])
    lag = windows.lagged(frame, ["x", "y"]).orderBy("idx").collect()
    assert [r["x_lag"] for r in lag] == [1, 1, 4, 4, 4] and [r["y_lag"] for r in lag] == [1, 1, 2, 3, 4]
    change = windows.differenced(frame, ["x", "y"]).orderBy("idx").collect()
    assert [r["x_diff"] for r in change] == [2, 2, 2, 2, 2] and [r["y_diff"] for r in change] == [1] * 5


def test_any_number_of_categories(spark):
    frame = spark.range(20_000).select(F.format_string("c%05d", F.expr("19999 - id")).alias("s"))
    found = encode.label_codes(frame.unionByName(spark.sql("SELECT CAST(NULL AS string) AS s")), "s", "code")
    assert found.filter("code = cast(substr(s, 2) AS int)").count() == 20_000 and found.filter("code IS NULL").count() == 1


def test_random_split_keeps_its_rows(spark):
    frame = spark.range(1000).withColumnRenamed("id", "idx")
    sides = [{r["idx"] for r in splits.random_split(frame.repartition(n)).filter("split = 'test'").collect()} for n in (3, 8)]
    assert sides[0] == sides[1] and 150 < len(sides[0]) < 250


def test_min_max_pipeline(spark):
    frame = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(10)], "x double, y double")
    model = learn.fit(frame, learn.linear("y"), ["x"], scale="minmax")
    scored = learn.score(model, frame)
    assert all(r["predicted"] == pytest.approx(r["y"]) for r in scored.collect())

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesmill.functions import columns as fc
from seriesmill.operators import aggregates, clean, correlation, profile
from seriesmill.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]


def quantile_table(found, *by):
    return {tuple(row[c] for c in (*by, "column_name", "probability")): row["value"]
            for row in found.collect()}


@pytest.mark.parametrize("exact_rows", [20, 10**9])
@pytest.mark.parametrize("kind", ["normal", "ties", "heavy", "one"])
def test_quantiles(spark, exact_rows, kind):
    random = np.random.default_rng(3)
    x = {
        "normal": random.normal(size=3001),
        "ties": random.integers(0, 4, 2000).astype(float),
        "heavy": np.exp(random.normal(0, 8, 2500)),
        "one": np.full(500, 2.5),
    }[kind]
    frame = spark.createDataFrame([(float(v),) for v in x], "x double")
    found = quantile_table(exact_quantiles(frame, ["x"], PROBABILITIES, exact_rows=exact_rows))
    for p in PROBABILITIES:
        assert found["x", p] == pytest.approx(np.quantile(x, p), rel=1e-12)


def test_quantiles_by_group_with_a_hot_group_and_nulls(spark):
    random = np.random.default_rng(5)
    groups = np.where(random.random(4000) < 0.6, "hot", random.choice(["a", "b"], 4000))
    x, y = random.normal(size=4000), random.gamma(2.0, size=4000)
    rows = [
        (g, float(a), None if i % 3 == 0 else float(b))
        for i, (g, a, b) in enumerate(zip(groups, x, y))
    ]
    frame = spark.createDataFrame(rows, "g string, x double, y double")
    found = quantile_table(exact_quantiles(frame, ["x", "y"], [0.25, 0.5], ["g"], exact_rows=30), "g")
    known = np.arange(4000) % 3 != 0
    for g in ("hot", "a", "b"):
        for p in (0.25, 0.5):
            assert found[g, "x", p] == pytest.approx(np.quantile(x[groups == g], p), rel=1e-12)
            chosen = y[(groups == g) & known]
            assert found[g, "y", p] == pytest.approx(np.quantile(chosen, p), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=5, max_size=60), st.floats(0, 1))
def test_quantile_search_on_any_values(spark, values, p):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    found = exact_quantiles(frame, ["x"], [p], exact_rows=2).first()["value"]
    assert found == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


def test_histogram_edges(series):
    found = profile.histogram(series(x=list(range(11))), "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in found] == [2, 2, 2, 2, 3]
    one = profile.histogram(series(x=[3, 3]), "x", 4).agg(F.sum("count")).first()[0]
    assert one == 2
    gaps = profile.histogram(series(x=[0, 10]), "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in gaps] == [1, 0, 0, 0, 1]


def test_density(series):
    random = np.random.default_rng(2)
    x = random.normal(size=300)
    found = profile.density(series(x=list(map(float, x))), "x").orderBy("point").toPandas()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    expected = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(found["x"], grid, rtol=1e-9)
    np.testing.assert_allclose(found["density"], expected, rtol=1e-9)
    merged = profile.density(series(x=list(map(float, x))), "x", cells=2000).orderBy("point").toPandas()
    np.testing.assert_allclose(merged["density"], expected, rtol=1e-4)
    assert profile.density(series(x=[1, 1]), "x").count() == 0


def test_box_plot_leaves_out_far_values(series):
    found = profile.box_plot(series(x=[1, 2, 3, 4, 100]), ["x"]).first()
    assert (found["q1"], found["median"], found["q3"]) == (2, 3, 4)
    assert (found["whisker_low"], found["whisker_high"], found["outliers"]) == (1, 4, 1)


def test_describe_and_shape(spark, price_table):
    frame = spark.createDataFrame(price_table)
    found = profile.describe(frame).toPandas().set_index("column_name")
    expected = price_table.describe().T
    for ours, theirs in zip(["count", "mean", "std", "min", "p25", "p50", "p75", "max"],
                            ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]):
        np.testing.assert_allclose(found.loc[expected.index, ours], expected[theirs], rtol=1e-9)
    shape = profile.shape(frame).collect()
    assert len(shape) == 17 and {r["rows"] for r in shape} == {len(price_table)}
    moments = profile.distribution_shape(frame, ["Food_Price"]).first()
    assert moments["skewness"] == pytest.approx(price_table["Food_Price"].skew())
    assert moments["kurtosis"] == pytest.approx(price_table["Food_Price"].kurtosis())
    one = profile.summary(frame, "Food_Price").first()
    assert one["median"] == pytest.approx(price_table["Food_Price"].median())


@pytest.mark.parametrize("wide", [3, 99])
def test_correlation_matrix_is_pairwise_complete(spark, price_table, monkeypatch, wide):
    monkeypatch.setattr(correlation, "WIDE", wide)
    random = np.random.default_rng(1)
    columns = ["Food_Price", "Previous_Price", "Rainfall", "Year"]
    pdf = price_table[columns].astype(float)
    pdf = pdf.mask(random.random(pdf.shape) < 0.2)
    pdf["constant"] = 4.0
    frame = fc.nan_to_null(spark.createDataFrame(pdf))
    found = correlation.correlation_matrix(frame).collect()
    assert len(found) == 10
    expected = pdf.corr()
    for row in found:
        value = expected.loc[row["row_name"], row["column_name"]]
        if np.isnan(value):
            assert row["corr"] is None or np.isnan(row["corr"])
        else:
            assert row["corr"] == pytest.approx(value, rel=1e-9)


def test_correlation_with_target(spark, price_table):
    frame = spark.createDataFrame(price_table)
    found = correlation.correlation_with(frame, "Food_Price")
    expected = price_table.corr(numeric_only=True)["Food_Price"]
    for row in found.collect():
        assert row["corr"] == pytest.approx(expected[row["column_name"]], abs=1e-9)
    assert correlation.strongest(found, 2).collect()[0]["column_name"] == "Food_Price"
    counted = correlation.count_above(found, "Food_Price").first()[0]
    assert counted == (expected.drop("Food_Price").abs() > 0.05).sum()


def test_null_counts(series):
    found = {r[0]: r[1] for r in clean.null_counts(series(x=[1, None], y=[None, None])).collect()}
    assert found == {"idx": 0, "x": 1, "y": 2, "(total)": 3}


def test_imputation(series):
    frame = series(x=[1, None, 3, 8], s=["a", None, "c", "d"])
    filled = clean.impute(frame, ["x"])
    assert [r["x"] for r in filled.orderBy("idx").collect()] == [1, 4, 3, 8]
    train = clean.impute(frame, ["x"], fit_on=F.col("idx") < 3)
    assert train.where("idx = 1").first()["x"] == 2
    assert clean.drop_incomplete(filled).count() == 3
    assert clean.fill_values(frame, ["x"], "median") == {"x": 3}
    assert clean.fill_values(series(x=[5, 2, 2, 5, None]), ["x"], "mode") == {"x": 2}


def test_nan_counts_as_null(spark):
    frame = spark.createDataFrame([(1.0, 1), (float("nan"), 2)], "x double, n int")
    cleaned = fc.nan_to_null(frame)
    assert clean.fill_values(cleaned) == {"x": 1.0}
    assert dict(clean.impute(cleaned).dtypes) == {"x": "double", "n": "int"}


def test_contract(spark, price_table):
    frame = spark.createDataFrame(price_table)
    report = clean.check_contract(
        frame, rows=700, columns=17, required=["Previous_Lag"], no_nulls=frame.columns,
        ranges={"Food_Price": (0.5, 15.0), "Demand_Index": (0.5, 1.5), "absent": (0, 1)},
    )
    passed = {r["rule"]: r["passed"] for r in report.collect()}
    assert passed == {
        "row_count": True, "column_count": True, "has_Previous_Lag": False, "no_nulls": True,
        "min_Food_Price": True, "max_Food_Price": True, "min_Demand_Index": True,
        "max_Demand_Index": True, "range_absent": False,
    }


def test_right_closed_bins(series):
    label = fc.right_closed_bin(F.col("x"), [0, 100, 200, 300], ["low", "mid", "high"])
    frame = series(x=[0, 100, 100.01, 300, 300.01, None]).withColumn("b", label)
    # 100.01 is in (100, 200]
    assert [r["b"] for r in frame.orderBy("idx").collect()] == [None, "low", "mid", "high", None, None]
    counted = aggregates.mean_by_bin(frame, "b", "x").collect()
    assert {r["b"] for r in counted} == {"low", "mid", "high"}


def test_half_even(spark):
    row = spark.range(1).select(fc.half_even(F.lit(2.5), 0), fc.half_even(F.lit(0.125), 2)).first()
    assert tuple(row) == (2.0, 0.12)


def test_monthly_mean_and_gaps(spark):
    rows = [(2020, 1, 1.0), (2020, 1, 3.0), (2020, 2, 4.0), (2020, 4, 8.0)]
    frame = spark.createDataFrame(rows, "year int, month int, v double")
    plain = aggregates.monthly_mean(frame, "v").orderBy("month_start").collect()
    assert [r["price"] for r in plain] == [2, 4, 8]
    gaps = aggregates.monthly_mean(frame, "v", fill_gaps=True).orderBy("month_start").collect()
    assert [r["price"] for r in gaps] == [2, 4, None, 8] and gaps[2]["n"] == 0
    extent = aggregates.series_extent(aggregates.monthly_mean(frame, "v")).first()
    assert extent["months"] == 3 and str(extent["last_month"]) == "2020-04-01"


def test_category_order(spark):
    frame = spark.createDataFrame([("Winter", 1.0), ("Winter", 3.0), ("Spring", 5.0)], "Season string, v double")
    found = aggregates.category_stats(frame, "Season", "v").orderBy("ordinal").collect()
    assert [r["Season"] for r in found] == list(fc.SEASONS)
    assert [r["mean"] for r in found] == [5, None, None, 2]


def test_share(series):
    shares = aggregates.with_share(series(x=[1, 3]), "x").orderBy("idx").collect()
    assert [r["pct"] for r in shares] == [25, 75]


def test_feature_name_prefix(spark):
    frame = spark.createDataFrame([("scale__a",), ("cat__Season_x",), ("plain",)], "n string")
    found = [r[0] for r in frame.select(fc.without_step_prefix(F.col("n"))).collect()]
    assert found == ["a", "Season_x", "plain"]


def test_quantiles_by_bad_sketch_are_exact(spark, monkeypatch):
    """Brackets that miss their ranks are widened to the whole range; tied and infinite values too."""
    from seriesmill.operators import quantiles as Q

    random = np.random.default_rng(5)
    x = np.r_[random.normal(size=900), np.zeros(300), [np.inf, -np.inf, 1e308]]
    y = np.r_[random.integers(0, 3, 1203)].astype(float)
    frame = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).repartition(5)
    points = [0.0, 0.1, 0.25, 0.2505, 0.5, 0.99, 1.0]
    plain = quantile_table(exact_quantiles(frame, ["x", "y"], points))
    assert quantile_table(exact_quantiles(frame, ["x", "y"], points, exact_rows=10)) == plain
    found = Q._sketched
    monkeypatch.setattr(Q, "_sketched", lambda *a: found(*a).withColumn("marks", F.transform("marks", lambda m: F.col("lo"))))
    assert quantile_table(exact_quantiles(frame, ["x", "y"], points, exact_rows=10)) == plain


def test_box_plot_by_group_with_null_keys_and_columns_without_values(spark):
    rows = [("a", float(v), None) for v in (1, 2, 3, 4, 100)] + [(None, float(v), float("nan")) for v in (5, 6, 7)]
    frame = spark.createDataFrame(rows, "g string, x double, y double")
    found = {(r["g"], r["column_name"]): r[2:] for r in profile.box_plot(frame, ["x", "y"], ["g"]).collect()}
    assert found == {("a", "x"): (2, 3, 4, 1, 4, 1), (None, "x"): (5.5, 6, 6.5, 5, 7, 0)}

"""Work, memory and parallelism that follow the rows."""

import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import aggregates, boosting, learn, metrics


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_gaps_are_filled_without_hashing_the_calendar(spark, capsys):
    rows = [("a", 2020, 11, 1.0), ("a", 2021, 2, 5.0), ("a", 2021, 2, 7.0), ("a", None, None, 3.0), ("a", None, 2, 9.0)]
    rows += [(None, 2020, 1, None), (None, 2020, 3, 2.0), ("b", None, None, 4.0)]
    frame = spark.createDataFrame(rows, "k string, year int, month int, v double")
    found = aggregates.monthly_mean(frame, "v", keys=["k"], fill_gaps=True)
    day = datetime.date
    expected = {
        ("a", day(2020, 11, 1), 1.0, 1), ("a", day(2020, 12, 1), None, 0), ("a", day(2021, 1, 1), None, 0), ("a", day(2021, 2, 1), 6.0, 2),
        ("a", None, 9.0, 1), ("b", None, 4.0, 1),
        (None, day(2020, 1, 1), None, 1), (None, day(2020, 2, 1), None, 0), (None, day(2020, 3, 1), 2.0, 1),
    }
    listed = [tuple(r) for r in found.select("k", "month_start", "price", "n").collect()]
    assert len(listed) == len(expected) and set(listed) == expected
    shown = plan(found, capsys)
    assert shown.count("HashAggregate(") == 2 and shown.count("Exchange") == 2


def test_draws_are_spread_over_tasks(spark, monkeypatch, capsys):
    rows = spark.range(300).select(
        F.lit("m").alias("model"), F.col("id").alias("idx"), F.lit(1.0).alias("actual"), (F.col("id") % 7).cast("double").alias("predicted")
    )
    whole = {r["replicate"]: r for r in metrics.bootstrap_scores(rows.coalesce(1), replicates=20).collect()}
    monkeypatch.setattr(metrics, "DRAWS_PER_TASK", 1000)
    spread = metrics.bootstrap_scores(rows.coalesce(1), replicates=20)
    assert "REPARTITION_BY_NUM" in plan(spread, capsys) and "conv(" not in plan(spread, capsys)
    for r in spread.collect():
        other = whole[r["replicate"]]
        assert r["n"] == other["n"] and r["rmse"] == pytest.approx(other["rmse"]) and r["mae"] == pytest.approx(other["mae"])


def test_draws_are_those_of_the_number_and_an_undrawn_row_counts_nowhere(spark):
    pairs = spark.range(2000).select(F.col("id").alias("idx"), (F.col("id") % 9).alias("k"))
    digits = F.substring(F.md5(F.concat(F.lit("42:"), F.col("idx"), F.lit(":"), F.col("k"))), 1, 8)
    u = F.conv(digits, 16, 10).cast("double") / float(1 << 32)
    number = sum(((u >= limit).cast("int") for limit in metrics.POISSON), F.lit(0))
    assert pairs.where(number != metrics.resampling_weight(F.col("idx"), F.col("k"))).count() == 0
    rows = spark.createDataFrame([("m", i, 1.0, float("inf") if i == 0 else 0.0) for i in range(40)], "model string, idx long, actual double, predicted double")
    drawn = {r.k for r in spark.range(1, 31).select(F.col("id").alias("k"), metrics.resampling_weight(F.lit(0), F.col("id")).alias("w")).where("w > 0").collect()}
    scores = {r["replicate"]: r["rmse"] for r in metrics.bootstrap_scores(rows, replicates=30).collect()}
    assert 0 < len(drawn) < 30 and all((scores[k] == float("inf")) == (k in drawn) for k in scores)


def test_boosting_rows_are_staged_in_chunks():
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 5, (20_000, 2)).astype(float), rng.random(20_000)
    x[::7, 1] = np.nan
    table = pa.table({"a": x[:, 0], "b": x[:, 1], "_y": y, "_late": np.arange(20_000) % 3 == 0})
    edges = [np.arange(4.0), np.arange(4.0)]
    chunks = list(boosting._codes(["a", "b"], edges, boosting.Boosted(["a", "b"], 2.5, []))(iter(table.to_batches(3000))))
    assert [len(c) for c in chunks] == [1, 1, 1]
    read = list(boosting._read(iter(chunks), 2, []))
    assert [c[0].shape[1] for c in read] == [boosting.CHUNK_ROWS, boosting.CHUNK_ROWS, 20_000 - 2 * boosting.CHUNK_ROWS]
    codes, target, late, margin = (np.concatenate(column, axis=-1) for column in zip(*read))
    assert (codes == np.where(np.isnan(x), boosting.MISSING, x).T).all() and (target == y).all()
    assert (late == (np.arange(20_000) % 3 == 0)).all() and (margin == 2.5).all()


def test_trees_are_fitted_on_evenly_dealt_rows(spark, monkeypatch):
    frame = spark.range(4000).select(
        F.col("id").cast("double").alias("a"), (F.col("id") % 3).cast("string").alias("k"), (F.col("id") % 50 + F.col("id") % 3).cast("double").alias("y"),
        (F.col("id") % 5 == 0).alias("late"),
    ).coalesce(1)
    seen, plain = [], learn.GBTRegressor.fit

    def fit(self, rows):
        seen.append((rows.rdd.getNumPartitions(), sorted(rows.columns)))
        return plain(self, rows)

    whole = learn.score(learn.fit(frame, learn.boosted_trees("y", 2), ["a"], "k"), frame)
    monkeypatch.setattr(learn, "ROWS_PER_TASK", 500)
    monkeypatch.setattr(learn.GBTRegressor, "fit", fit)
    dealt = learn.score(learn.fit(frame, learn.boosted_trees("y", 2), ["a"], "k"), frame)
    learn.fit(frame, learn.boosted_trees("y", 2, "late"), ["a"], "k")
    assert seen == [(8, ["features", "y"]), (8, ["features", "late", "y"])]
    pairs = whole.join(dealt.select("a", F.col("predicted").alias("again")), "a")
    assert pairs.where("abs(predicted - again) > 1e-6").count() == 0 and pairs.count() == 4000

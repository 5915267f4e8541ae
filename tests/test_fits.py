import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import metrics, tall_qr, windows
from seriesmill.plans.fitting_queries import permuted


def noisy(n=500, seed=0):
    rng = np.random.default_rng(seed)
    a = rng.normal(1e6, 1, n)
    x = np.column_stack([a, a + rng.normal(0, 1e-3, n), rng.integers(0, 4, n)])
    return x, x @ [2.0, -3.0, 0.5] + 7 + rng.normal(0, 0.1, n)


def test_qr_equals_lstsq_on_nearly_dependent_columns(spark):
    x, y = noisy()
    frame = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(y=y)).repartition(7)
    found = tall_qr.fit(frame, list("abc"), "y")
    wanted = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x - x.mean(0)]), y, rcond=None)[0]
    assert np.allclose(found[1:], wanted[1:], rtol=1e-4)
    predicted = [r[0] for r in frame.select((tall_qr.value(list("abc"), found) - F.col("y")).alias("e")).collect()]
    assert np.std(predicted) < 0.11


def test_folds_in_one_pass(spark):
    x, y = noisy(230, 3)
    x = x - x.mean(0)
    frame = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(y=y, idx=range(230))).repartition(5)
    frame = frame.withColumn("c", F.when(F.col("idx") != 11, F.col("c")))
    found = {r.idx: (r.fold, r.predicted) for r in tall_qr.cross_validate(frame, list("abc"), "y", 4).collect()}
    size = 230 // 5
    assert len(found) == 4 * size
    for k in range(4):
        start = 230 - (4 - k) * size
        use = np.array([i for i in range(start) if i != 11])
        w = np.linalg.lstsq(np.column_stack([np.ones(len(use)), x[use]]), y[use], rcond=None)[0]
        for i in range(start, start + size):
            assert found[i][0] == k + 1 and found[i][1] == pytest.approx(w[0] + x[i] @ w[1:], abs=1e-5)


def test_qr_of_odd_tables(spark):
    empty = spark.createDataFrame([], "a double, y double, idx long")
    assert tall_qr.fit(empty, ["a"], "y").tolist() == [0.0, 0.0]
    same = spark.createDataFrame([(2.0, 5.0), (2.0, 7.0), (None, 1.0)], "a double, y double")
    found = tall_qr.fit(same, ["a"], "y")
    assert found[0] + 2 * found[1] == pytest.approx(6)


def test_bootstrap_weights(spark):
    rows = spark.range(4000).select(F.col("id").alias("idx"), F.lit("m").alias("model"), F.lit(1.0).alias("actual"), (F.col("id") % 7).cast("double").alias("predicted"))
    drawn = rows.select(metrics.resampling_weight(F.col("idx"), F.lit(3)).alias("w")).groupBy("w").count().collect()
    share = {r.w: r["count"] / 4000 for r in drawn}
    assert all(abs(share.get(k, 0) - math.exp(-1) / math.factorial(k)) < 0.03 for k in range(4))
    each = metrics.bootstrap_scores(rows, replicates=30)
    assert each.count() == 30 and {r.n for r in each.collect()} != {4000}
    again = metrics.bootstrap_scores(rows.repartition(5), replicates=30)
    assert sorted((r.replicate, r.n) for r in each.collect()) == sorted((r.replicate, r.n) for r in again.collect())
    (row,) = metrics.bootstrap_intervals(rows, replicates=30).collect()
    whole = math.sqrt(np.mean([(1 - i % 7) ** 2 for i in range(4000)]))
    assert row.rmse_lower < whole < row.rmse_upper and row.mae_lower <= row.mae_median <= row.mae_upper


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_change_by_days(spark, keys):
    rng = np.random.default_rng(5)
    days = np.sort(rng.integers(0, 120, 90))
    days[60:] += 200
    rows = [(int(i), ["a", "b"][i % 2], None if i == 3 else datetime(2024, 1, 1) + timedelta(days=int(d), hours=int(i % 3)), None if i % 11 == 5 else float(rng.integers(100))) for i, d in enumerate(days)]
    frame = spark.createDataFrame(rows, "id long, k string, t timestamp, v double").repartition(3)
    found = {r.id: r for r in windows.change_since(frame, "v", "t", "id", (7, 30), keys).collect()}
    assert len(found) == len(rows)
    for i, k, t, v in rows:
        for d in (7, 30):
            known = [(u, j, w) for j, q, u, w in rows if u is not None and w is not None and t is not None and u <= t - timedelta(days=d) and (not keys or q == k)]
            wanted = v - max(known)[2] if known and v is not None else None
            assert found[i][f"v_change_{d}d"] == wanted


def test_permutation(spark):
    frame = spark.createDataFrame([(i, float(i * i)) for i in range(101)], "idx long, x double").repartition(3)
    moved = {r.idx: r.x for r in permuted(frame, "x", 101).collect()}
    assert sorted(moved.values()) == sorted(float(i * i) for i in range(101)) and sum(moved[i] == i * i for i in range(101)) < 10

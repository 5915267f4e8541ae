import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import order, windows


def values(df, *columns, by="idx"):
    return [tuple(row) if len(columns) > 1 else row[0] for row in df.orderBy(by).select(*columns).collect()]


def keyed_frame(spark, n=600, hot=0.5, nulls=0.4, seed=1):
    random = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "key": np.where(random.random(n) < hot, "hot", random.choice(list("abcdef"), n)),
            "ts": random.integers(0, 20, n),  # many equal times
            "x": random.normal(size=n).round(3),
        }
    )
    pdf["y"] = pdf["x"].where(random.random(n) > nulls)
    frame = spark.createDataFrame(pdf).withColumn("y", F.nanvl("y", F.lit(None)))
    return pdf, frame.repartition(7)


def test_positions_are_dense_and_in_order(spark):
    pdf, frame = keyed_frame(spark)
    found = order.with_position(frame, ["ts", "id"]).select("id", "idx").toPandas()
    expected = pdf.sort_values(["ts", "id"])["id"].tolist()
    assert found.sort_values("idx")["id"].tolist() == expected
    assert sorted(found["idx"]) == list(range(len(pdf)))


def test_positions_of_one_hot_time_use_several_partitions(spark):
    frame = spark.range(20_000).select("id", F.lit(1).alias("ts")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = order.with_position(frame, ["ts", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert placed.where("idx != id").count() == 0
    assert len(placed.inputFiles()) > 1


def test_positions_of_an_empty_frame(spark):
    assert order.with_position(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("block_rows", [4, 7, 100_000])
def test_block_windows_equal_one_long_window(spark, block_rows):
    pdf, frame = keyed_frame(spark)
    placed = order.with_position(frame, ["ts", "id"])

    def build(window):
        return {
            "lag": windows.lag_with_head("x", window),
            "diff": windows.difference_with_head("x", window),
            "avg": windows.rolling_mean("y", window),
        }

    found = order.over_blocks(placed, build, back=2, ahead=1, block_rows=block_rows).toPandas()
    found = found.sort_values("idx").reset_index(drop=True)
    whole = pdf.sort_values(["ts", "id"]).reset_index(drop=True)
    assert found["id"].tolist() == whole["id"].tolist()
    np.testing.assert_allclose(found["lag"], whole["x"].shift(1).bfill())
    np.testing.assert_allclose(found["diff"], whole["x"].diff().bfill())
    np.testing.assert_allclose(found["avg"], whole["y"].rolling(3, min_periods=1).mean(), atol=1e-12)


@pytest.mark.parametrize("block_rows", [5, 100_000])
@pytest.mark.parametrize("largest", [5, 100_000])
def test_keyed_windows_with_a_hot_key(spark, block_rows, largest):
    pdf, frame = keyed_frame(spark)
    whole = pdf.sort_values(["key", "ts", "id"])
    expected = whole.assign(
        lag=whole.groupby("key")["x"].transform(lambda s: s.shift(1).bfill()),
        avg=whole.groupby("key")["x"].transform(lambda s: s.rolling(3, min_periods=1).mean()),
    ).sort_values("id")

    def build(window):
        return {
            "lag": windows.lag_with_head("x", window),
            "avg": windows.rolling_mean("x", window),
        }

    placed = order.with_position(frame, ["key", "ts", "id"])
    blocks = order.over_blocks(placed, build, 2, 1, keys=["key"], block_rows=block_rows)
    direct = order.over_series(frame, build, ["ts", "id"], 2, 1, keys=["key"], largest=largest)
    for made in (blocks, direct):
        found = made.toPandas().sort_values("id")
        np.testing.assert_allclose(found["lag"], expected["lag"])
        np.testing.assert_allclose(found["avg"], expected["avg"], atol=1e-12)


@pytest.mark.parametrize("block_rows", [10, 50, 100_000])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_nearest_known(spark, block_rows, keys):
    pdf, frame = keyed_frame(spark, nulls=0.9)
    placed = order.with_position(frame, [*keys, "ts", "id"])
    whole = pdf.sort_values([*keys, "ts", "id"])
    groups = whole.groupby("key")["y"] if keys else whole["y"]
    for direction, expected in (("next", groups.bfill()), ("last", groups.ffill())):
        found = order.nearest_known(placed, ["y"], direction, keys, block_rows=block_rows)
        found = found.toPandas().sort_values("idx")
        np.testing.assert_allclose(found["y_filled"].astype(float), expected)


def test_nearest_known_tells_null_keys_apart(spark):
    rows = [(0, None, None), (1, None, 1.0), (2, None, None), (3, "a", None), (4, "a", 5.0)]
    frame = spark.createDataFrame(rows, "idx long, key string, y double")
    found = order.nearest_known(frame, ["y"], "last", ["key"], block_rows=2)
    assert values(found, "y_filled") == [None, 1.0, 1.0, None, 5.0]


@pytest.mark.parametrize("block_rows", [10, 100_000])
def test_running_total(spark, block_rows):
    pdf, frame = keyed_frame(spark)
    placed = order.with_position(frame, ["key", "ts", "id"])
    found = order.running_total(placed, "x", "sum", ["key"], block_rows=block_rows).toPandas()
    whole = pdf.sort_values(["key", "ts", "id"])
    expected = whole.groupby("key")["x"].cumsum()
    np.testing.assert_allclose(found.sort_values("idx")["sum"], expected, atol=1e-9)


def test_blocks_must_hold_the_frame(spark):
    with pytest.raises(ValueError):
        order.over_blocks(spark.range(3).withColumnRenamed("id", "idx"), lambda w: {}, 5, block_rows=5)


# Hand-computed tables


def test_lag_head(series):
    assert values(windows.lagged(series(x=[10, 20, 30]), ["x"]), "x_lag") == [10, 10, 20]


def test_rolling(series):
    rolled = windows.rolled(series(x=[3, 6, 9, 12], y=[3, None, 9, 12]), ["x", "y"])
    assert values(rolled, "x_avg") == [3, 4.5, 6, 9]
    assert values(rolled, "y_avg") == [3, 3, 6, 10.5]


def test_difference_head(series):
    assert values(windows.differenced(series(x=[5, 7, 4]), ["x"]), "x_diff") == [2, 2, -3]


def test_back_fill(series):
    filled = order.nearest_known(series(x=[None, None, 3, None]), ["x"], "next")
    assert values(filled, "x_filled") == [3, 3, 3, None]


def test_supervised_window(series):
    made = windows.supervised_windows(series(x=list(range(1, 15))), ["x"], 12)
    assert values(made, "x") == [13, 14]
    assert values(made, "lag_12") == [1, 2]
    array = windows.supervised_windows(series(x=list(range(1, 15))), ["x"], 12, as_array=True)
    assert values(array, "window")[0] == [float(i) for i in range(1, 13)]


def test_supervised_window_keeps_null_slots(series):
    made = windows.supervised_windows(series(x=[1, None, 3, 4]), ["x"], 2, as_array=True)
    assert values(made, "window") == [[1, None], [None, 3]]


@pytest.mark.parametrize("block_rows", [13, 100_000])
def test_supervised_window_at_block_edges(series, block_rows):
    made = windows.supervised_windows(
        series(x=list(range(60))), ["x"], 12, block_rows=block_rows
    )
    assert values(made, "idx") == list(range(12, 60))
    assert made.where("lag_12 != x - 12 or lag_1 != x - 1").count() == 0


def test_second_difference_and_inverse(series):
    x = [3, 7, 4, 9, 20]
    second = windows.nth_difference(series(x=x), "x", 2, "d2")
    assert values(second, "d2") == [None, None, *np.diff(x, 2)]
    first = windows.nth_difference(second, "x", 1, "d")
    start = first.withColumn("start", F.when(F.col("idx") == 0, F.col("x")))
    assert values(windows.undo_difference(start, "start", "d", "back", block_rows=2), "back") == x


def test_velocity_and_horizon(series):
    x = [float(i * i) for i in range(40)]
    fast = windows.velocity(series(x=x), "x", block_rows=31)
    assert values(fast, "x_velocity_7")[7:] == [x[i] - x[i - 7] for i in range(7, 40)]
    ahead = windows.future_targets(series(x=x), "x", block_rows=5)
    assert values(ahead, "x_ahead_3") == [*x[3:], None, None, None]

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import boosting


def plain_tree(x, y, margin, use, depth, step, penalty, least):
    """One tree by trying every value of every feature; returns nested tuples."""

    def gain(g, n):
        return g * g / (n + penalty)

    def grow(rows, level):
        g, n = (margin - y)[rows].sum(), len(rows)
        best = (0.0,)
        if level < depth:
            for f in use:
                known = rows[~np.isnan(x[rows, f])]
                lost = rows[np.isnan(x[rows, f])]
                for t in np.unique(x[known, f]):
                    for side in (False, True) if len(lost) else (False,):
                        left = np.concatenate((known[x[known, f] <= t], lost if side else lost[:0]))
                        right = np.setdiff1d(rows, left)
                        value = gain((margin - y)[left].sum(), len(left)) + gain((margin - y)[right].sum(), len(right)) - gain(g, n)
                        if len(left) and len(right) and value > best[0] + 1e-9:
                            best = (value, f, t, side, left, right)
        leaf = -step * g / (n + penalty)
        if len(best) == 1:
            return leaf
        a, b = grow(best[4], level + 1), grow(best[5], level + 1)
        if best[0] < least and not isinstance(a, tuple) and not isinstance(b, tuple):
            return leaf
        return best[1], best[2], best[3], a, b

    return grow(np.arange(len(y)), 0)


def plain_value(tree, row):
    while isinstance(tree, tuple):
        f, t, side, a, b = tree
        tree = (a if side else b) if np.isnan(row[f]) else a if row[f] <= t else b
    return tree


def table(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 30, n), rng.integers(0, 3, n), rng.integers(0, 50, n)]).astype(float)
    x[rng.random(n) < 0.1, 1] = np.nan
    y = 3 * x[:, 0] - np.nan_to_num(x[:, 1], nan=40) + 5 * (x[:, 2] == 1) * x[:, 0] + rng.normal(0, 1, n)
    return x, y


NAMES = ["a", "b", "c", "d"]


def frame(spark, x, y):
    data = pd.DataFrame(x, columns=NAMES).assign(y=y, i=np.arange(len(y)))
    return spark.createDataFrame(data).withColumn("b", F.when(~F.isnan("b"), F.col("b"))).repartition(3)


@pytest.mark.parametrize("depth,rounds,share,least", [(1, 2, 1.0, 0.2), (3, 12, 0.5, 0.2), (3, 4, 1.0, 400.0)])
def test_equals_plain_version(spark, depth, rounds, share, least):
    x, y = table()
    model = boosting.fit(frame(spark, x, y), NAMES, "y", rounds, depth, share=share, least_gain=least)
    margin = np.full(len(y), y.mean())
    losses = [((margin - y) ** 2).mean()]
    for turn in range(rounds):
        tree = plain_tree(x, y, margin, boosting.chosen_features(NAMES, turn, share, 42), depth, 0.3, 1.0, least)
        margin = margin + [plain_value(tree, row) for row in x]
        losses.append(((margin - y) ** 2).mean())
    found = {r.i: r.predicted for r in boosting.predict(frame(spark, x, y), model).collect()}
    assert np.allclose([found[i] for i in range(len(y))], margin)
    assert np.allclose([a for a, _ in model.losses], losses)


def test_patience_and_going_on(spark):
    x, y = table(300)
    rng = np.random.default_rng(2)
    y = y * 0.02 + rng.normal(0, 4, len(y))
    rows, late = frame(spark, x, y), F.col("i") >= 220
    whole = boosting.fit(rows, NAMES, "y", 30, late=late)
    curve = [b for _, b in whole.losses[1:]]
    best = next(i for i in range(len(curve)) if curve[i] == min(curve[: i + 6]) and len(curve) > i + 5)
    stopped = boosting.fit(rows, NAMES, "y", 30, late=late, patience=5)
    assert len(stopped.trees) == best + 1 and stopped.losses[-1][1] == pytest.approx(curve[best])
    half = boosting.fit(rows, NAMES, "y", 4, late=late)
    more = boosting.fit(rows, NAMES, "y", 7, late=late, start=boosting.from_table(boosting.as_table(spark, half)))
    assert len(more.trees) == 7
    for a, b in zip(more.trees, whole.trees):
        size = min(len(a.value), len(b.value))
        assert np.allclose(a.value[:size], b.value[:size]) and (a.feature[:size] == b.feature[:size]).all()


def test_saved_model_predicts_the_same(spark, tmp_path):
    x, y = table()
    rows = frame(spark, x, y)
    model = boosting.fit(rows, NAMES, "y", 3)
    boosting.save(spark, model, str(tmp_path / "model"))
    again = boosting.load(spark, str(tmp_path / "model"))
    values = np.vstack([x, [[np.nan] * 4], [[-9.0, 99, 7, 1.5]]]).T
    assert np.allclose(model.margins(values), again.margins(values))
    shares = {r.feature: r for r in boosting.importance(spark, model).collect()}
    assert sum(r.pct for r in shares.values()) == pytest.approx(100) and sum(r.splits for r in shares.values()) > 0
    assert again.features == NAMES and max(shares.values(), key=lambda r: r.gain).feature in "ab"


def test_quantile_ranges_and_odd_tables(spark):
    rng = np.random.default_rng(4)
    x, y = np.column_stack([rng.random((2000, 3)), np.full(2000, np.nan)]), rng.random(2000)
    y = y + 10 * (x[:, 0] > 0.5)
    model = boosting.fit(frame(spark, x, y), NAMES, "y", 5, share=1.0, bins=32)
    assert ((model.margins(x.T) - y) ** 2).mean() < 2.5 and abs(model.trees[0].threshold[1] - 0.5) < 0.05
    empty = frame(spark, x, y).limit(0)
    assert boosting.fit(empty, NAMES, "y", 2).margins(x.T).tolist() == [0.0] * 2000
    one = boosting.fit(frame(spark, x[:1], y[:1]), NAMES, "y", 2)
    assert one.margins(x[:1].T)[0] == pytest.approx(y[0])

"""Registered queries: boosted trees, least squares by QR, bootstrap intervals, permutation importance, change by time."""

from __future__ import annotations

from math import gcd

from pyspark.sql import functions as F

from seriesmill.operators import boosting, encode, metrics, tall_qr, windows
from seriesmill.plans.check_sql import given
from seriesmill.plans.inputs import fixed_predictions, rounded
from seriesmill.plans.model_queries import _FEATURES, ROUNDS, SEASONS, _rounded_scores, _spend_rows, _train
from seriesmill.plans.model_sql import stumps
from seriesmill.plans.registry import query
from seriesmill.session import stage
from seriesmill.sources.tables import observations

STUMP_FEATURES = ["n_lines", "month", "day"]

_SPENT = """spent AS (SELECT *, row_number() OVER (ORDER BY obs_ts, obs_id) - 1 AS i, count(*) OVER () AS n
                      FROM obs WHERE spend IS NOT NULL)"""
_STUMP_ROWS = f"""+ {_SPENT},
rows0 AS MATERIALIZED (SELECT obs_id, i < floor(n * 0.8) AS train, n_lines, CAST(month AS DOUBLE) AS month, CAST(day AS DOUBLE) AS day,
         spend AS y, (SELECT avg(spend) FROM spent WHERE i < floor(n * 0.8)) AS margin FROM spent),
"""


def _stumps(rows, rounds, **settings):
    return boosting.fit(rows.where(_train()), STUMP_FEATURES, "spend", rounds, depth=1, share=1.0, **settings)


@query(
    "G6 G7",
    given("obs", _STUMP_ROWS + stumps(STUMP_FEATURES, 2) + "\nSELECT obs_id, round(margin, 3) AS predicted FROM rows2 WHERE NOT train"),
)
def boosted_stumps(spark, folder):
    rows = _spend_rows(spark, folder)
    tested = boosting.predict(rows.where(F.col("split") == "test"), _stumps(rows, 2))
    return rounded(tested.select("obs_id", "predicted"), ["predicted"], 3)


@query(
    "G8 F4 C13",
    given(
        "obs",
        _STUMP_ROWS + stumps(STUMP_FEATURES, 6) + """,
        gains AS (""" + " UNION ALL ".join(f"SELECT feature, gain FROM best{k}" for k in range(6)) + f"""),
        sums AS (SELECT f AS feature, coalesce(sum(gain), 0) AS gain, count(gain) AS splits
                 FROM (SELECT unnest({STUMP_FEATURES}) AS f) LEFT JOIN gains ON f = feature GROUP BY f)
        SELECT feature, splits, round(100 * gain / sum(gain) OVER (), 4) AS pct FROM sums ORDER BY pct DESC, feature LIMIT 15""",
    ),
)
def summed_gain_importance(spark, folder):
    found = boosting.importance(spark, _stumps(_spend_rows(spark, folder), 6))
    top = found.orderBy(F.desc("pct"), "feature").limit(15)
    return rounded(top.select("feature", "splits", "pct"), ["pct"], 4)


@query("G6 G7 E11 G1")
def regularised_tree_scores(spark, folder):
    """Depth 3, half of the features per tree, leaf penalty 1, least gain 0.2; tested against a plain version."""
    rows = encode.one_hot(_spend_rows(spark, folder), "season", ["Autumn", *SEASONS])
    model = boosting.fit(rows.where(_train()), _FEATURES, "spend", ROUNDS)
    predictions = metrics.as_predictions(boosting.predict(rows, model), "regularised_trees", "row", "spend", "predicted", split="split")
    return _rounded_scores(metrics.regression_metrics(predictions, ["model", "split"]))


PATIENCE, MOST_ROUNDS = 5, 60

#: All rows of one line count have one margin, so the curve needs counts and sums per line count only.
_CURVE = f"""+ {_SPENT},
marked AS (SELECT n_lines AS v, spend AS y, i < floor(floor(n * 0.8) * 0.9) AS train FROM spent WHERE i < floor(n * 0.8)),
kept AS (SELECT v, count(*) FILTER (train) AS c, coalesce(sum(y) FILTER (train), 0) AS s, count(*) FILTER (NOT train) AS vc,
                coalesce(sum(y) FILTER (NOT train), 0) AS vs, coalesce(sum(y * y) FILTER (NOT train), 0) AS vq FROM marked GROUP BY v),
r0 AS MATERIALIZED (SELECT *, (SELECT avg(y) FROM marked WHERE train) AS m FROM kept),
""" + ",\n".join(
    f"""cut{k} AS (SELECT v, sum(c * m - s) OVER w AS lg, sum(c) OVER w AS lc, sum(c * m - s) OVER () AS g, sum(c) OVER () AS c
          FROM r{k} WINDOW w AS (ORDER BY v)),
b{k} AS MATERIALIZED (SELECT *, lg * lg / (lc + 1) + (g - lg) * (g - lg) / (c - lc + 1) - g * g / (c + 1) AS gain
          FROM cut{k} WHERE lc > 0 AND lc < c ORDER BY gain DESC, v LIMIT 1),
r{k + 1} AS MATERIALIZED (SELECT r.* REPLACE (m - 0.3 * CASE WHEN r.v <= b.v THEN b.lg / (b.lc + 1) ELSE (b.g - b.lg) / (b.c - b.lc + 1) END AS m)
          FROM r{k} r CROSS JOIN b{k} b)"""
    for k in range(MOST_ROUNDS)
) + """,
curve AS (""" + " UNION ALL ".join(
    f"SELECT {k} AS trees, sum(vc * m * m - 2 * m * vs + vq) / sum(vc) AS loss FROM r{k}" for k in range(1, MOST_ROUNDS + 1)
) + f"""),
best AS (SELECT trees, loss, min(loss) OVER (ORDER BY trees) AS least FROM curve),
steps AS (SELECT trees, loss, max(CASE WHEN loss = least THEN trees END) OVER (ORDER BY trees) AS last_best FROM best),
stops AS (SELECT coalesce(min(trees) FILTER (trees - last_best >= {PATIENCE}), {MOST_ROUNDS}) AS stop_at FROM steps)
SELECT last_best AS trees, round((SELECT sqrt(loss) FROM curve WHERE curve.trees = last_best), 3) AS validation_rmse
FROM steps JOIN stops ON steps.trees = stop_at"""


@query("G12 D9", given("obs", _CURVE))
def patient_stumps(spark, folder):
    """Trees kept by early stopping with patience, and their error on the last tenth of the training rows."""
    rows = _spend_rows(spark, folder).where(_train())
    cut = int(rows.count() * 0.9)
    model = boosting.fit(
        rows, ["n_lines"], "spend", MOST_ROUNDS, depth=1, share=1.0, late=F.col("idx") >= cut, patience=PATIENCE
    )
    found = [(len(model.trees), model.losses[-1][1] ** 0.5)]
    return rounded(spark.createDataFrame(found, "trees int, validation_rmse double"), ["validation_rmse"], 3)


def _multiplier(rows: int) -> int:
    """A number near the golden section of ``rows`` without a common divisor: positions times it are a permutation."""
    found = max(1, int(rows * 0.6180339887498949))
    while gcd(found, max(rows, 1)) > 1:
        found += 1
    return found


def permuted(rows, column, size, shift=17):
    """The column's values on other rows: position p takes that of (p * m + shift) mod size, by one join and no sort."""
    partner = F.expr(f"(idx * {_multiplier(size)}L + {shift}L) % {max(size, 1)}L")
    given_away = rows.select(F.col("idx").alias("_from"), F.col(column).alias("_given"))
    moved = rows.withColumn("_from", partner).join(given_away, "_from").drop("_from", column)
    return moved.withColumnRenamed("_given", column)


@query(
    "G8",
    given(
        "obs",
        f"""+ {_SPENT},
        fit AS (SELECT regr_slope(spend, n_lines) AS b, regr_intercept(spend, n_lines) AS a FROM spent WHERE i < floor(n * 0.8)),
        size AS (SELECT any_value(n) AS n, CAST(floor(any_value(n) * 0.6180339887498949) AS BIGINT) AS start FROM spent),
        m AS (SELECT min(start + k) AS m, any_value(n) AS n FROM size, range(0, 1000) t(k) WHERE gcd(start + k, n) = 1),
        p AS (SELECT x.i, x.n, x.spend, x.n_lines, o.n_lines AS other FROM spent x, m JOIN spent o ON o.i = (x.i * m.m + 17) % m.n),
        e AS (SELECT sqrt(avg((spend - a - b * n_lines) ** 2)) AS base, sqrt(avg((spend - a - b * other) ** 2)) AS moved FROM p, fit WHERE i >= floor(n * 0.8))
        SELECT 'n_lines' AS feature, round(moved - base, 3) AS rmse_increase FROM e UNION ALL SELECT 'day', 0.0""",
    ),
)
def permutation_importance(spark, folder):
    """Rise of the test error when a feature's values are dealt to other rows; ``day`` is not in the model."""
    rows = _spend_rows(spark, folder)
    found = tall_qr.fit(rows, ["n_lines"], "spend", _train())
    size = rows.count()

    def error(frame):
        tested = frame.where(F.col("split") == "test").withColumn("predicted", tall_qr.value(["n_lines"], found))
        return tested.agg(F.sqrt(F.avg(F.pow(F.col("spend") - F.col("predicted"), 2)))).head()[0]

    base = error(rows)
    out = [(name, error(permuted(rows, name, size)) - base) for name in ("n_lines", "day")]
    return rounded(spark.createDataFrame(out, "feature string, rmse_increase double"), ["rmse_increase"], 3)


REPLICATES = 40
_WEIGHT = " + ".join(f"CAST(u >= {limit!r} AS INT)" for limit in metrics.POISSON)


@query(
    "P8",
    given(
        "predicted",
        f"""+ d AS (SELECT model, k, actual - predicted AS e,
                 ('0x' || substr(md5('42:' || idx || ':' || k), 1, 8))::BIGINT / 4294967296.0 AS u
               FROM predicted, range(1, {REPLICATES + 1}) t(k) WHERE split = 'test'),
        w AS (SELECT model, k, e, {_WEIGHT} AS w FROM d),
        r AS (SELECT model, k, sqrt(sum(w * e * e) / sum(w)) AS rmse, sum(w * abs(e)) / sum(w) AS mae FROM w GROUP BY model, k)
        SELECT model, count(*) AS replicates, """
        + ", ".join(
            f"round(quantile_cont({c}, {p}), 3) AS {c}_{name}"
            for c in ("rmse", "mae")
            for name, p in (("lower", 0.05), ("median", 0.5), ("upper", 0.95))
        )
        + " FROM r GROUP BY model",
    ),
)
def bootstrap_score_intervals(spark, folder):
    rows = stage(fixed_predictions(spark, folder).where(F.col("split") == "test"), "predictions")
    found = metrics.bootstrap_intervals(rows, ["model"], REPLICATES)
    return rounded(found, [f"{c}_{e}" for c in ("rmse", "mae") for e in ("lower", "median", "upper")], 3)


@query(
    "P7",
    given(
        "obs",
        """+ known AS (SELECT CAST(obs_ts AS TIMESTAMP) AS t, max_by(price, obs_id) AS price FROM obs WHERE price IS NOT NULL GROUP BY obs_ts)
        SELECT o.obs_id, round(o.price - a.price, 6) AS price_change_7d, round(o.price - b.price, 6) AS price_change_30d
        FROM obs o ASOF LEFT JOIN known a ON CAST(o.obs_ts AS TIMESTAMP) - INTERVAL 7 DAY >= a.t
        ASOF LEFT JOIN known b ON CAST(o.obs_ts AS TIMESTAMP) - INTERVAL 30 DAY >= b.t""",
    ),
)
def price_change_by_days(spark, folder):
    rows = stage(observations(spark, folder, ["obs_id", "obs_ts", "price"]), "observations")
    made = ["price_change_7d", "price_change_30d"]
    return rounded(windows.change_since(rows, "price", "obs_ts", "obs_id").select("obs_id", *made), made)

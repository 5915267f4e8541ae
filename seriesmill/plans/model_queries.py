"""Registered queries: fitted models on the observation table."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.functions.columns import right_closed_bin
from seriesmill.operators import aggregates, encode, forecast, learn, least_squares, metrics, order, splits, tall_qr
from seriesmill.operators.correlation import cross_products
from seriesmill.plans.check_sql import given
from seriesmill.plans.inputs import monthly_prices, rounded
from seriesmill.plans.model_sql import partialled
from seriesmill.plans.registry import query
from seriesmill.session import stage
from seriesmill.sources.tables import ORDER_KEYS, observations, table

DRIVERS = ["n_lines", "qty", "disc", "tax", "year", "month", "day"]
SCORES = ["rmse", "mae", "mape_pct", "r2"]
ROUNDS = 100


def _spend_rows(spark, folder):
    """Rows with a known spend, positioned in time order and split 80/20; staged for refits."""
    rows = observations(spark, folder, [*ORDER_KEYS, "season", "spend", *DRIVERS])
    placed = order.with_position(rows.where(F.col("spend").isNotNull()), ORDER_KEYS)
    return stage(splits.temporal_split(placed), "spend-rows")


def _train(column="split"):
    return F.col(column) == "train"


@query(
    "G5",
    given(
        "obs",
        "+ v AS (SELECT n_lines AS a, qty / 100 AS b, spend / 100000 AS c FROM obs"
        " WHERE spend IS NOT NULL AND qty IS NOT NULL)\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{x}{y}' AS pair, round(sum({x} * {y}) / count(*), 6) AS mean_product FROM v"
            for x, y in ("aa", "ab", "ac", "bb", "bc", "cc")
        ),
    ),
)
def cross_product_sums(spark, folder):
    rows = observations(spark, folder, ["n_lines", "qty", "spend"]).select(
        F.col("n_lines").alias("a"),
        (F.col("qty") / 100).alias("b"),
        (F.col("spend") / 100_000).alias("c"),
    )
    names = F.array(*map(F.lit, ["aa", "ab", "ac", "bb", "bc", "cc"])).alias("pair")
    sums = cross_products(rows, ["a", "b", "c"])
    pairs = sums.select("n", F.explode(F.arrays_zip(names, "gram")).alias("_p"))
    return pairs.select(
        F.col("_p.pair").alias("pair"), F.round(F.col("_p.gram") / F.col("n"), 6).alias("mean_product")
    )


@query(
    "G5 G7",
    given(
        "obs",
        """+ spent AS (SELECT *, row_number() OVER (ORDER BY obs_ts, obs_id) - 1 AS i,
                           count(*) OVER () AS n FROM obs WHERE spend IS NOT NULL),
        fit AS (SELECT regr_slope(spend, n_lines) AS b, regr_intercept(spend, n_lines) AS a
                FROM spent WHERE i < floor(n * 0.8))
        SELECT obs_id, round(a + b * n_lines, 3) AS predicted FROM spent, fit
        WHERE i >= floor(n * 0.8)""",
    ),
)
def spend_from_line_count(spark, folder):
    rows = _spend_rows(spark, folder)
    model = learn.fit(rows, learn.linear("spend"), ["n_lines"], fit_on=_train())
    tested = learn.score(model, rows.where(F.col("split") == "test"))
    return rounded(tested.select("obs_id", "predicted"), ["predicted"], 3)


def _scores(model, rows, name):
    predictions = metrics.as_predictions(
        learn.score(model, rows), name, "row", "spend", "predicted", split="split"
    )
    return rounded(metrics.regression_metrics(predictions, ["model", "split"]), SCORES, 4)


#: All drivers and the season's dummies; which season is left out does not change the fit.
SEASONS = ["Spring", "Summer", "Winter"]
_FEATURES = [*DRIVERS, *[f"season_{s}" for s in SEASONS]]
_FEATURE_SQL = ", ".join(
    [*(f"CAST({c} AS DOUBLE) AS {c}" for c in DRIVERS), *(f"CAST(season = '{s}' AS INT)::DOUBLE AS season_{s}" for s in SEASONS)]
)
_SCORE_SQL = """count(*) AS n, round(sqrt(avg(residual * residual)), 2) AS rmse, round(avg(abs(residual)), 2) AS mae,
       round(avg(abs(residual) / greatest(abs(actual), 2.220446049250313e-16)) * 100, 3) AS mape_pct,
       round(1 - sum(residual * residual) / (var_pop(actual) * count(*)), 5) AS r2"""


def _rounded_scores(frame):
    return rounded(rounded(rounded(frame, ["rmse", "mae"], 2), ["mape_pct"], 3), ["r2"], 5)


@query(
    "G4 G5 G7 G1 G2",
    given(
        "obs",
        f"""+ spent AS (SELECT *, row_number() OVER (ORDER BY obs_ts, obs_id) - 1 AS i,
                           count(*) OVER () AS total FROM obs WHERE spend IS NOT NULL),
        t0 AS (SELECT spend AS actual, i < floor(total * 0.8) AS train, spend, {_FEATURE_SQL} FROM spent),
        """
        + partialled(_FEATURES, "spend", "actual")
        + f"\nSELECT 'linear' AS model, CASE WHEN train THEN 'train' ELSE 'test' END AS split, {_SCORE_SQL} FROM fitted GROUP BY train",
    ),
)
def linear_model_scores(spark, folder):
    rows = _spend_rows(spark, folder)
    model = learn.fit(rows, learn.linear("spend"), DRIVERS, "season", _train())
    scored = learn.score(model, rows)
    predictions = metrics.as_predictions(scored, "linear", "row", "spend", "predicted", split="split")
    return _rounded_scores(metrics.regression_metrics(predictions, ["model", "split"]))


@query("G4 G6 G7 E11")
def boosted_tree_scores(spark, folder):
    rows = _spend_rows(spark, folder)
    trees = learn.boosted_trees("spend", ROUNDS)
    return _scores(learn.fit(rows, trees, DRIVERS, "season", _train()), rows, "trees")


@query("G8 F4 C12 C13")
def feature_importance(spark, folder):
    rows = _spend_rows(spark, folder)
    model = learn.fit(rows, learn.boosted_trees("spend", ROUNDS), DRIVERS, "season", _train())
    return rounded(learn.top_features(learn.importance(model, rows), 15), ["importance", "pct"])


@query(
    "G9 G5 D8 E10",
    given(
        "obs",
        f"""+ spent AS (SELECT *, row_number() OVER (ORDER BY obs_ts, obs_id) - 1 AS i FROM obs WHERE spend IS NOT NULL),
        s AS (SELECT count(*) AS n, count(*) // 6 AS size FROM spent),
        f AS (SELECT CAST(k AS INT) AS fold, n - (6 - k) * size AS a, n - (5 - k) * size AS b
              FROM (SELECT unnest([1, 2, 3, 4, 5]) AS k), s),
        t0 AS (SELECT fold, spend AS actual, i < a AS train, spend, {_FEATURE_SQL} FROM spent JOIN f ON i < b),
        """
        + partialled(_FEATURES, "spend", "actual", ["fold"])
        + f"\nSELECT fold, {_SCORE_SQL} FROM fitted WHERE NOT train GROUP BY fold",
    ),
)
def cross_validation_scores(spark, folder):
    """All folds from one pass over the rows, by merged R factors."""
    rows = encode.one_hot(_spend_rows(spark, folder), "season", ["Autumn", *SEASONS])
    tested = tall_qr.cross_validate(rows, _FEATURES, "spend")
    return _rounded_scores(metrics.regression_metrics(tested, ["fold"], actual="spend"))


@query(
    "G9 G5 D8 E10",
    given(
        "obs",
        """+ spent AS (SELECT *, row_number() OVER (ORDER BY obs_ts, obs_id) - 1 AS i
                     FROM obs WHERE spend IS NOT NULL),
        s AS (SELECT count(*) AS n, count(*) // 6 AS size FROM spent),
        f AS (SELECT CAST(k AS INT) AS fold, n - (6 - k) * size AS a, n - (5 - k) * size AS b
              FROM (SELECT unnest([1, 2, 3, 4, 5]) AS k), s),
        fit AS (SELECT fold, regr_slope(spend, n_lines) AS m, regr_intercept(spend, n_lines) AS c
                FROM spent JOIN f ON i < a GROUP BY fold),
        e AS (SELECT fold, spend, spend - c - m * n_lines AS error
              FROM spent JOIN f ON i >= a AND i < b JOIN fit USING (fold))
        SELECT fold, count(*) AS n, round(sqrt(avg(error * error)), 4) AS rmse,
               round(avg(abs(error)), 4) AS mae,
               round(1 - sum(error * error) / (var_pop(spend) * count(*)), 6) AS r2
        FROM e GROUP BY fold""",
    ),
)
def cross_validation_of_line_count_fit(spark, folder):
    rows = _spend_rows(spark, folder)
    tested = learn.cross_validate(rows, lambda: learn.linear("spend"), ["n_lines"])
    found = metrics.regression_metrics(tested, ["fold"], actual="spend").drop("mape_pct")
    return rounded(rounded(found, ["rmse", "mae"], 4), ["r2"])


@query("G12 G6 D9")
def early_stopped_trees(spark, folder):
    rows = _spend_rows(spark, folder)
    train = rows.where(_train())
    cut = int(train.count() * 0.9)
    marked = train.withColumn("is_val", F.col("idx") >= cut)
    trees = learn.boosted_trees("spend", ROUNDS, validation="is_val", validationTol=0.01)
    model = learn.fit(marked, trees, DRIVERS, "season")
    used = model.stages[-1].getNumTrees
    return _scores(model, rows, "stopped_trees").withColumn("trees", F.lit(used))


@query(
    "H5 C11 F3 E4 G7",
    given(
        "obs",
        f"""+ spent AS (SELECT *, row_number() OVER (ORDER BY obs_ts, obs_id) - 1 AS i,
                           count(*) OVER () AS total FROM obs WHERE spend IS NOT NULL),
        t0 AS (SELECT qty AS amount, i < floor(total * 0.8) AS train, spend, {_FEATURE_SQL} FROM spent),
        """
        + partialled(_FEATURES, "spend", "amount")
        + """
        SELECT CASE WHEN amount <= 100 THEN 'Low (<100)' WHEN amount <= 200 THEN 'Mid (100-200)' ELSE 'High (>200)' END AS qty_group,
               count(*) AS n, round(avg(abs(residual)), 3) AS mean_abs_error
        FROM fitted WHERE amount > 0 AND amount <= 300 GROUP BY 1""",
    ),
)
def spend_error_report(spark, folder):
    rows = _spend_rows(spark, folder)
    model = learn.fit(rows, learn.linear("spend"), DRIVERS, "season", _train())
    scored = metrics.with_errors(learn.score(model, rows), actual="spend")
    labels = ["Low (<100)", "Mid (100-200)", "High (>200)"]
    group = right_closed_bin(F.col("qty"), [0, 100, 200, 300], labels)
    binned = scored.withColumn("qty_group", group)
    return rounded(
        aggregates.mean_by_bin(binned, "qty_group", "abs_error"), ["mean_abs_error"], 3
    )


def _month_changes(spark, folder, lags, keys=()):
    months = monthly_prices(spark, folder, keys)
    placed = order.with_position(months, [*keys, "month_start"])
    return forecast.change_lags(placed, "price", lags, keys=keys)


@query(
    "G10 D12",
    given(
        "month_ord",
        """+ d AS (SELECT *, price - lag(price) OVER (ORDER BY idx) AS change FROM month_ord)
        SELECT month_start, round(change, 5) AS change,"""
        + ", ".join(
            f"round(lag(change, {k}) OVER (ORDER BY idx), 5) AS change_{k}" for k in range(1, 6)
        )
        + " FROM d",
    ),
)
def autoregression_inputs(spark, folder):
    names = ["change", *forecast.change_names(5)]
    return rounded(_month_changes(spark, folder, 5).select("month_start", *names), names, 5)


@query(
    "G10 D12",
    given(
        "month_ord",
        """+ d AS (SELECT *, price - lag(price) OVER (ORDER BY idx) AS c0 FROM month_ord),
        e AS (SELECT *, lag(c0) OVER (ORDER BY idx) AS c1, lag(c0, 2) OVER (ORDER BY idx) AS c2
              FROM d),
        g AS (SELECT sum(c1 * c1) AS s11, sum(c1 * c2) AS s12, sum(c2 * c2) AS s22,
                     sum(c1 * c0) AS s10, sum(c2 * c0) AS s20 FROM e WHERE c2 IS NOT NULL),
        phi AS (SELECT (s10 * s22 - s20 * s12) / (s11 * s22 - s12 * s12) AS p1,
                       (s20 * s11 - s10 * s12) / (s11 * s22 - s12 * s12) AS p2 FROM g)
        SELECT month_start, round(price - c0 + p1 * c1 + p2 * c2, 4) AS predicted FROM e, phi""",
    ),
)
def monthly_autoregression_two_lags(spark, folder):
    changes = _month_changes(spark, folder, 2)
    model = forecast.fit_autoregression(changes, 2)
    scored = forecast.predict_autoregression(changes, model, "price", 2)
    return rounded(scored.select("month_start", "predicted"), ["predicted"], 4)


@query(
    "G10",
    """
    WITH d AS (SELECT event_id, user_id, ts, value, value - lag(value) OVER w AS c0 FROM events
               WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    e AS (SELECT *, lag(c0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS c1 FROM d),
    f AS (SELECT user_id, sum(c0 * c1) / sum(c1 * c1) AS phi FROM e WHERE c1 IS NOT NULL
          GROUP BY user_id)
    SELECT event_id, round(value - c0 + phi * c1, 6) AS predicted FROM e JOIN f USING (user_id)""",
)
def user_autoregression_one_lag(spark, folder):
    keys = ["user_id"]
    rows = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    placed = order.with_position(rows, ["user_id", "ts", "event_id"])
    changes = forecast.change_lags(placed, "value", 1, keys=keys)
    model = forecast.fit_autoregression(changes, 1, keys)
    scored = forecast.predict_autoregression(changes, model, "value", 1, keys)
    return rounded(scored.select("event_id", "predicted"), ["predicted"])


_CHANGES = ["change", *forecast.change_names(5)]


@query(
    "G10 G5",
    given(
        "month_ord",
        "+ d AS (SELECT idx, (price - lag(price) OVER (ORDER BY idx)) / 10000 AS change"
        " FROM month_ord), e AS (SELECT change, "
        + ", ".join(f"lag(change, {k}) OVER (ORDER BY idx) AS change_{k}" for k in range(1, 6))
        + " FROM d), f AS (SELECT * FROM e WHERE change_5 IS NOT NULL)\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{a} {b}' AS pair, count(*) AS n, round(avg({a} * {b}), 6) AS mean_product FROM f"
            for i, a in enumerate(_CHANGES)
            for b in _CHANGES[i:]
        ),
    ),
)
def autoregression_cross_products(spark, folder):
    rows = _month_changes(spark, folder, 5).select(
        *[(F.col(c) / 10_000).alias(c) for c in _CHANGES]
    )
    pairs = [f"{a} {b}" for i, a in enumerate(_CHANGES) for b in _CHANGES[i:]]
    names = F.array(*map(F.lit, pairs)).alias("pair")
    sums = cross_products(rows, _CHANGES)
    each = sums.select("n", F.explode(F.arrays_zip(names, "gram")).alias("_p"))
    mean = F.col("_p.gram") / F.col("n")
    return each.select(
        F.col("_p.pair").alias("pair"), "n", F.round(mean, 6).alias("mean_product")
    )


def _autoregression_sql(keys=""):
    """Five lags of the change without an intercept: what the residual leaves of the value is the prediction."""
    own, group = (f"{keys}, ", f"{keys}, ") if keys else ("", "")
    over = f"OVER ({f'PARTITION BY {keys} ' if keys else ''}ORDER BY month_start)"
    lags = ", ".join(f"lag(c, {k}) {over} AS c{k}" for k in range(1, 6))
    return f"""+ m AS (SELECT {own}make_date(year, month, 1) AS month_start, avg(price) AS price FROM obs GROUP BY {group}year, month),
        d AS (SELECT *, price - lag(price) {over} AS c FROM m),
        e AS (SELECT *, {lags} FROM d),
        t0 AS (SELECT {own}month_start, price, TRUE AS train, c1, c2, c3, c4, c5, c FROM e WHERE c5 IS NOT NULL),
        {partialled([f"c{k}" for k in range(1, 6)], "c", "month_start, price", [keys] if keys else [], intercept=False)}
        SELECT {'m.' + keys + ', ' if keys else ''}m.month_start, {'' if keys else 'round(m.price, 4) AS price, '}round(m.price - residual, {3 if keys else 4}) AS predicted
        FROM m LEFT JOIN fitted f ON f.month_start = m.month_start{f' AND f.{keys} = m.{keys}' if keys else ''}"""


@query("G10", given("obs", _autoregression_sql()))
def monthly_autoregression(spark, folder):
    changes = _month_changes(spark, folder, 5)
    model = forecast.fit_autoregression(changes, 5)
    scored = forecast.predict_autoregression(changes, model, "price", 5)
    return rounded(scored.select("month_start", "price", "predicted"), ["price", "predicted"], 4)


@query("G10", given("obs", _autoregression_sql("series_key")))
def monthly_autoregression_by_segment(spark, folder):
    keys = ["series_key"]
    changes = _month_changes(spark, folder, 5, keys)
    model = forecast.fit_autoregression(changes, 5, keys)
    scored = forecast.predict_autoregression(changes, model, "price", 5, keys)
    return rounded(scored.select(*keys, "month_start", "predicted"), ["predicted"], 3)


@query(
    "G11 G3 D6 D9",
    given(
        "month_ord",
        """+ s AS (SELECT CAST(floor(count(*) * 0.9) AS BIGINT) AS cut FROM month_ord),
        r AS (SELECT *, lag(price) OVER (ORDER BY idx) AS before FROM month_ord, s),
        f AS (SELECT regr_slope(price, before) AS b, regr_intercept(price, before) AS a
              FROM r WHERE idx < cut)
        SELECT month_start, CASE WHEN idx < cut THEN 'train' ELSE 'val' END AS split,
               round(price, 4) AS actual, round(a + b * before, 4) AS predicted
        FROM r, f WHERE before IS NOT NULL""",
    ),
)
def window_forecast_one_slot(spark, folder):
    months = order.with_position(monthly_prices(spark, folder), ["month_start"])
    made = forecast.window_forecast(months, length=1)
    return rounded(
        made.select("month_start", "split", "actual", "predicted"), ["actual", "predicted"], 4
    )


@query(
    "G11 G3 D6 D9",
    given(
        "month_ord",
        "+ l AS (SELECT month_start, idx, price, idx < floor((SELECT count(*) FROM month_ord) * 0.9) AS train, "
        + ", ".join(f"lag(price, {k}) OVER (ORDER BY idx) AS p{k}" for k in range(1, 13))
        + " FROM month_ord), t0 AS (SELECT * EXCLUDE (idx), price AS actual FROM l WHERE p12 IS NOT NULL),\n"
        + partialled([f"p{k}" for k in range(1, 13)], "price", "month_start, actual")
        + "\nSELECT month_start, CASE WHEN train THEN 'train' ELSE 'val' END AS split, round(actual, 4) AS actual,"
        " round(actual - residual, 4) AS predicted FROM fitted",
    ),
)
def window_forecast_twelve_slots(spark, folder):
    months = order.with_position(monthly_prices(spark, folder), ["month_start"])
    made = forecast.window_forecast(months, length=12)
    return rounded(
        made.select("month_start", "split", "actual", "predicted"), ["actual", "predicted"], 4
    )


@query(
    "G11",
    """
    WITH n AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n,
                      lag(value) OVER w AS before
               FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
    f AS (SELECT event_type, regr_slope(value, before) AS b, regr_intercept(value, before) AS a
          FROM n WHERE i < floor(n * 0.9) GROUP BY event_type)
    SELECT event_id, CASE WHEN i < floor(n * 0.9) THEN 'train' ELSE 'val' END AS split,
           round(a + b * before, 6) AS predicted
    FROM n JOIN f USING (event_type) WHERE before IS NOT NULL""",
)
def window_forecast_by_event_type(spark, folder):
    keys = ["event_type"]
    rows = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    placed = order.with_position(rows, ["event_type", "ts", "event_id"])
    made = forecast.window_forecast(placed, "value", length=1, keys=keys)
    return rounded(made.select("event_id", "split", "predicted"), ["predicted"])


@query(
    "P6",
    given(
        "month_ord",
        """+ c AS (SELECT idx, price - avg(price) OVER () AS x FROM month_ord)
        SELECT CAST(k AS INT) AS lag, round(sum(a.x * b.x) / (SELECT sum(x * x) FROM c), 6) AS acf
        FROM c a JOIN (SELECT unnest(range(1, 13)) AS k) ON true JOIN c b ON b.idx = a.idx - k
        GROUP BY k""",
    ),
)
def monthly_autocorrelation(spark, folder):
    months = order.with_position(monthly_prices(spark, folder), ["month_start"])
    return rounded(forecast.autocorrelation(months, "price", 12), ["acf"])


@query(
    "P6",
    given(
        "month_ord",
        """+ r AS (SELECT price - lag(price) OVER (ORDER BY idx) AS d,
                         lag(price) OVER (ORDER BY idx) AS b FROM month_ord),
        s AS (SELECT count(*) AS n, regr_slope(d, b) AS g, covar_pop(d, b) AS c, var_pop(b) AS vb,
                     var_pop(d) AS vd FROM r WHERE b IS NOT NULL)
        SELECT n, round(g, 6) AS gamma,
               round(g / sqrt(n * (vd - g * c) / (n - 2) / (n * vb)), 6) AS t FROM s""",
    ),
)
def monthly_unit_root_test(spark, folder):
    months = order.with_position(monthly_prices(spark, folder), ["month_start"])
    return rounded(forecast.unit_root_statistic(months, "price"), ["gamma", "t"])


@query(
    "G5",
    """SELECT user_id, count(*) AS n, round(regr_slope(value, x), 6) AS slope,
              round(regr_intercept(value, x), 6) AS intercept
       FROM (SELECT user_id, value, CAST(hour(ts) AS DOUBLE) AS x FROM events) GROUP BY user_id""",
)
def user_trend_by_hour(spark, folder):
    rows = table(spark, folder, "events").select(
        "user_id", "value", F.hour("ts").cast("double").alias("x")
    )
    model = least_squares.fit_linear(rows, ["x"], "value", ["user_id"])
    return model.select(
        "user_id",
        "n",
        F.round(F.element_at("coefficients", 1), 6).alias("slope"),
        F.round(F.element_at("coefficients", 2), 6).alias("intercept"),
    )


@query("H3 H4 E8 E14 G4 G5 G6 G10 G11")
def all_models_compared(spark, folder):
    rows = _spend_rows(spark, folder)
    months = order.with_position(
        aggregates.monthly_mean(rows, "spend"), ["month_start"]
    )
    changes = forecast.change_lags(months, "price", 5)
    auto = forecast.predict_autoregression(
        changes, forecast.fit_autoregression(changes, 5), "price", 5
    )
    window = forecast.window_forecast(months, length=12)
    parts = [
        metrics.as_predictions(auto, "autoregression(5,1,0)", "month", "price", "predicted"),
        metrics.as_predictions(window, "window(12)", "month", "actual", "predicted"),
    ]
    for name, regressor in (
        ("linear", learn.linear("spend")),
        ("trees", learn.boosted_trees("spend", ROUNDS)),
    ):
        model = learn.fit(rows, regressor, DRIVERS, "season", _train())
        tested = learn.score(model, rows.where(F.col("split") == "test"))
        parts.append(metrics.as_predictions(tested, name, "row", "spend", "predicted"))
    compared = metrics.compare_models(parts)
    return rounded(metrics.improvement_over(compared, "autoregression(5,1,0)"), ["improvement_pct"], 4)

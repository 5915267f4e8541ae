"""Registered queries: positions, ordered windows, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.operators import clean, order, splits, windows
from seriesmill.operators.aggregates import population_shift
from seriesmill.operators.encode import extremes, min_max_restored, min_max_scaled, standardised
from seriesmill.operators.features import ORDER_FEATURES
from seriesmill.plans.check_sql import given
from seriesmill.plans.inputs import (
    engineered,
    monthly_prices,
    ordered,
    rounded,
    staged,
)
from seriesmill.plans.registry import query
from seriesmill.sources.tables import observations, table

USER_ORDER = ("user_id", "ts", "event_id")
TYPE_ORDER = ("event_type", "ts", "event_id")


def _events(spark, folder, by):
    """Events with their position in an order that starts with the series key."""
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    return order.with_position(table(spark, folder, "events").select(*columns), by)


@query("D5", given("ord", "SELECT obs_id, idx FROM ord"))
def row_positions(spark, folder):
    return ordered(spark, folder, []).select("obs_id", "idx")


@query(
    "D1",
    given(
        "ord",
        """SELECT obs_id, idx, coalesce(lag(price) OVER (ORDER BY idx), price) AS price_lag
           FROM ord""",
    ),
)
def lag_with_head_filled(spark, folder):
    return windows.lagged(ordered(spark, folder, ["price"]), ["price"]).select(
        "obs_id", "idx", "price_lag"
    )


@query(
    "D1 D4",
    given(
        "ord",
        """+ l AS (SELECT obs_id, idx, lag(qty) OVER (ORDER BY idx) AS q FROM ord)
        SELECT obs_id, idx, first_value(q IGNORE NULLS) OVER (
               ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS qty_lag
        FROM l""",
    ),
)
def lag_with_nulls_back_filled(spark, folder):
    rows = windows.lagged(ordered(spark, folder, ["qty"]), ["qty"], head="null")
    filled = order.nearest_known(rows, ["qty_lag"], "next")
    return filled.select("obs_id", "idx", F.col("qty_lag_filled").alias("qty_lag"))


@query(
    "D2",
    given(
        "ord",
        "SELECT obs_id, idx, "
        + ", ".join(
            f"round(avg({c}) OVER (ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 7)"
            f" AS {c}_avg"
            for c in ("qty", "disc", "ext")
        )
        + " FROM ord",
    ),
)
def rolling_means(spark, folder):
    columns = ["qty", "disc", "ext"]
    rows = windows.rolled(ordered(spark, folder, columns), columns)
    made = [f"{c}_avg" for c in columns]
    return rounded(rows.select("obs_id", "idx", *made), made, 7)


@query(
    "D3",
    given(
        "filled",
        "SELECT obs_id, idx, "
        + ", ".join(
            f"round(coalesce({c} - lag({c}) OVER w, lead({c}) OVER w - {c}), 7) AS {c}_diff"
            for c in ("tax", "n_lines")
        )
        + " FROM filled WINDOW w AS (ORDER BY idx)",
    ),
)
def first_differences(spark, folder):
    columns = ["tax", "n_lines"]
    rows = clean.impute(ordered(spark, folder, columns), columns)
    made = [f"{c}_diff" for c in columns]
    return rounded(
        windows.differenced(rows, columns).select("obs_id", "idx", *made), made, 7
    )


_NEAREST = """first_value({c} IGNORE NULLS) OVER (
    ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


@query(
    "D4",
    given(
        "ord",
        "SELECT obs_id, idx, "
        + _NEAREST.format(c="qty")
        + " AS qty_filled, "
        + _NEAREST.format(c="spend")
        + " AS spend_filled FROM ord",
    ),
)
def back_fill(spark, folder):
    rows = ordered(spark, folder, ["qty", "spend"])
    return order.nearest_known(rows, ["qty", "spend"], "next").select(
        "obs_id", "idx", "qty_filled", "spend_filled"
    )


@query(
    "P1",
    given(
        "ord",
        """SELECT obs_id, idx, last_value(qty IGNORE NULLS) OVER (
             ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS qty_filled FROM ord""",
    ),
)
def forward_fill(spark, folder):
    rows = ordered(spark, folder, ["qty"])
    return order.nearest_known(rows, ["qty"], "last").select("obs_id", "idx", "qty_filled")


@query(
    "D1 D2 D3",
    """
    SELECT event_id, round(coalesce(lag(value) OVER w, value), 6) AS value_lag,
           round(coalesce(value - lag(value) OVER w, lead(value) OVER w - value), 6) AS value_diff,
           round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS value_avg
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def user_series_windows(spark, folder):
    columns = ["event_id", "ts", "user_id", "value"]
    rows = table(spark, folder, "events").select(*columns)

    def build(window):
        return {
            "value_lag": windows.lag_with_head("value", window),
            "value_diff": windows.difference_with_head("value", window),
            "value_avg": windows.rolling_mean("value", window),
        }

    made = order.over_series(rows, build, ["ts", "event_id"], back=2, ahead=1, keys=["user_id"])
    columns = ["value_lag", "value_diff", "value_avg"]
    return rounded(made.select("event_id", *columns), columns)


@query(
    "D4 P1",
    """
    WITH e AS (SELECT event_id, event_type, ts, CASE WHEN value >= 20 THEN value END AS big
               FROM events)
    SELECT event_id,
           first_value(big IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_big,
           last_value(big IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_big
    FROM e""",
)
def event_type_fills(spark, folder):
    rows = _events(spark, folder, TYPE_ORDER).select(
        "event_id", "event_type", "idx", F.when(F.col("value") >= 20, F.col("value")).alias("big")
    )
    keys = ["event_type"]
    ahead = order.nearest_known(rows, ["big"], "next", keys).withColumnRenamed(
        "big_filled", "next_big"
    )
    both = order.nearest_known(ahead, ["big"], "last", keys)
    return both.select("event_id", "next_big", F.col("big_filled").alias("last_big"))


_SLOTS = ", ".join(f"lag(price, {k}) OVER (ORDER BY idx) AS lag_{k}" for k in range(12, 0, -1))


@query(
    "D6",
    given(
        "ord",
        f"""SELECT * FROM (SELECT obs_id, idx, {_SLOTS}, price AS target FROM ord)
            WHERE idx >= 12""",
    ),
)
def supervised_window(spark, folder):
    rows = windows.supervised_windows(ordered(spark, folder, ["price"]), ["price"], 12)
    return rows.select("obs_id", "idx", *windows.lag_names(12), F.col("price").alias("target"))


@query(
    "D6",
    """
    SELECT event_id, lag_3, lag_2, lag_1, value AS target FROM (
      SELECT event_id, value, lag(value, 3) OVER w AS lag_3, lag(value, 2) OVER w AS lag_2,
             lag(value) OVER w AS lag_1,
             row_number() OVER w AS rn
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE rn > 3""",
)
def user_supervised_window(spark, folder):
    rows = windows.supervised_windows(
        _events(spark, folder, USER_ORDER), ["value"], 3, keys=["user_id"]
    )
    return rows.select("event_id", *windows.lag_names(3), F.col("value").alias("target"))


@query(
    "P11 D6",
    given(
        "ord",
        "SELECT * FROM (SELECT obs_id, idx, "
        + ", ".join(
            f"lag({c}, {k}) OVER (ORDER BY idx) AS {c}_lag_{k}"
            for c in ("price", "qty", "n_lines")
            for k in range(12, 0, -1)
        )
        + ", price AS target FROM ord) WHERE idx >= 12",
    ),
)
def multivariate_window(spark, folder):
    columns = ["price", "qty", "n_lines"]
    rows = windows.supervised_windows(ordered(spark, folder, columns), columns, 12)
    slots = [name for c in columns for name in windows.lag_names(12, f"{c}_lag")]
    return rows.select("obs_id", "idx", *slots, F.col("price").alias("target"))


@query(
    "P10",
    given(
        "ord",
        """SELECT obs_id, lead(price, 1) OVER w AS price_ahead_1, lead(price, 2) OVER w AS
           price_ahead_2, lead(price, 3) OVER w AS price_ahead_3
           FROM ord WINDOW w AS (ORDER BY idx)""",
    ),
)
def horizon_targets(spark, folder):
    rows = windows.future_targets(ordered(spark, folder, ["price"]), "price")
    return rows.select("obs_id", *[f"price_ahead_{h}" for h in (1, 2, 3)])


@query(
    "P7",
    given(
        "ord",
        """SELECT obs_id, round(price - lag(price, 7) OVER w, 6) AS price_velocity_7,
           round(price - lag(price, 30) OVER w, 6) AS price_velocity_30
           FROM ord WINDOW w AS (ORDER BY idx)""",
    ),
)
def price_velocity(spark, folder):
    made = ["price_velocity_7", "price_velocity_30"]
    rows = windows.velocity(ordered(spark, folder, ["price"]), "price")
    return rounded(rows.select("obs_id", *made), made)


@query(
    "D12",
    given(
        "ord",
        """+ d AS (SELECT obs_id, idx, price, price - lag(price) OVER (ORDER BY idx) AS d1 FROM ord)
        SELECT obs_id, idx, round(d1, 4) AS change,
               round(d1 - lag(d1) OVER (ORDER BY idx), 4) AS change_of_change,
               round(price, 4) AS rebuilt
        FROM d""",
    ),
)
def differences_and_inverse(spark, folder):
    rows = ordered(spark, folder, ["price"])
    rows = windows.nth_difference(rows, "price", 1, "change")
    rows = windows.nth_difference(rows, "price", 2, "change_of_change")
    first = rows.withColumn("_start", F.when(F.col("idx") == 0, F.col("price")))
    rebuilt = windows.undo_difference(first, "_start", "change", "rebuilt")
    made = ["change", "change_of_change", "rebuilt"]
    return rounded(rebuilt.select("obs_id", "idx", *made), made, 4)


@query(
    "D7",
    given(
        "ord size",
        """SELECT obs_id, idx, CASE WHEN idx < cut THEN 'train' ELSE 'test' END AS split
           FROM ord, size""",
    ),
)
def temporal_train_test_split(spark, folder):
    return splits.temporal_split(ordered(spark, folder, [])).select("obs_id", "idx", "split")


@query(
    "D8",
    given(
        "ord",
        """+ s AS (SELECT count(*) AS n, count(*) // 6 AS size FROM ord),
        f AS (SELECT CAST(k AS INT) AS fold, n - (6 - k) * size AS a, n - (5 - k) * size AS b
              FROM (SELECT unnest([1, 2, 3, 4, 5]) AS k), s)
        SELECT fold, CASE WHEN idx < a THEN 'train' ELSE 'test' END AS role, count(*) AS rows,
               min(idx) AS first_idx, max(idx) AS last_idx, round(avg(price), 6) AS mean_price
        FROM ord JOIN f ON idx < b GROUP BY 1, 2""",
    ),
)
def expanding_window_folds(spark, folder):
    known = F.col("price").isNotNull().cast("long")
    wanted = {
        "rows": ("sum", F.lit(1)),
        "first_idx": ("min", F.col("idx")),
        "last_idx": ("max", F.col("idx")),
        "total": ("sum", F.col("price")),
        "known": ("sum", known),
    }
    found = splits.fold_aggregates(ordered(spark, folder, ["price"]), wanted)
    mean = F.round(F.try_divide("total", "known"), 6).alias("mean_price")
    return found.select("fold", "role", "rows", "first_idx", "last_idx", mean)


@query(
    "D9",
    given(
        "month_ord",
        """+ s AS (SELECT CAST(floor(count(*) * 0.9) AS BIGINT) AS cut FROM month_ord)
        SELECT month_start, CASE WHEN idx < cut THEN 'train' ELSE 'val' END AS split,
               round(price, 6) AS target, round(oldest, 6) AS oldest, round(newest, 6) AS newest
        FROM (SELECT *, lag(price, 12) OVER w AS oldest, lag(price) OVER w AS newest
              FROM month_ord WINDOW w AS (ORDER BY idx)), s WHERE idx >= 12""",
    ),
)
def overlapping_validation_windows(spark, folder):
    months = order.with_position(monthly_prices(spark, folder), ["month_start"])
    rows = windows.supervised_windows(months, ["price"], 12)
    split = splits.split_by_target(rows, months.count())
    return split.select(
        "month_start",
        "split",
        F.round("price", 6).alias("target"),
        F.round("lag_12", 6).alias("oldest"),
        F.round("lag_1", 6).alias("newest"),
    )


@query(
    "D10 C13",
    given(
        "ord size",
        """SELECT CASE WHEN idx < cut THEN 'train' ELSE 'test' END AS split, count(*) AS rows,
                  min(idx) AS first_idx, max(idx) AS last_idx, min(price) AS min_target,
                  max(price) AS max_target, round(count(*) * 100.0 / any_value(n), 6) AS pct
           FROM ord, size GROUP BY 1""",
    ),
)
def split_summary(spark, folder):
    rows = splits.temporal_split(ordered(spark, folder, ["price"]))
    return rounded(splits.split_report(rows, "price"), ["pct"])


@query(
    "D11 B11",
    given(
        "ord size",
        """SELECT count(*) FILTER (WHERE idx < cut) AS train_rows,
                  count(*) FILTER (WHERE idx >= cut) AS test_rows,
                  max(CASE WHEN idx < cut THEN obs_ts END) <= min(CASE WHEN idx >= cut THEN obs_ts END)
                    AS in_order,
                  abs(count(*) FILTER (WHERE idx < cut) - any_value(cut)) <= 1 AS sizes_ok
           FROM ord, size""",
    ),
)
def leakage_report(spark, folder):
    rows = splits.temporal_split(ordered(spark, folder, []))
    return splits.leakage_check(rows, time="obs_ts")


@query(
    "P4",
    given(
        "ord",
        """+ s AS (SELECT idx, obs_ts, ('0x' || substr(md5('42:' || idx), 1, 8))::BIGINT / 4294967296.0 < 0.2 AS test FROM ord)
        SELECT count(*) FILTER (NOT test) AS train_rows, count(*) FILTER (test) AS test_rows,
               max(idx) FILTER (NOT test) < min(idx) FILTER (test)
               AND max(obs_ts) FILTER (NOT test) <= min(obs_ts) FILTER (test) AS in_order FROM s""",
    ),
)
def random_split_leak(spark, folder):
    rows = splits.random_split(ordered(spark, folder, ["price"]))
    return splits.leakage_check(rows, time="obs_ts").select("train_rows", "test_rows", "in_order")


@query(
    "P5",
    given(
        "obs",
        """SELECT obs_id, price, CAST(c AS INT) AS copy
           FROM obs, (SELECT unnest([1, 2, 3]) AS c)
           WHERE c = 1 OR price < 10000 OR price > 490000""",
    ),
)
def oversampled_price_extremes(spark, folder):
    rows = observations(spark, folder, ["obs_id", "price"])
    return splits.oversample(rows, "price", 10_000, 490_000, 3)


@query(
    "H1 D1 D2 D3 C4 C5 C6",
    given(
        "engineered",
        "SELECT obs_id, idx, season, round(price, 6) AS price, "
        + ", ".join(
            f"round({c}, {8 if c == 'disc_bal' else 7}) AS {c}"
            for c in ["previous_price", *ORDER_FEATURES.made]
        )
        + " FROM engineered",
    ),
)
def engineered_features(spark, folder):
    made = ["previous_price", *ORDER_FEATURES.made]
    rows = engineered(spark, folder).select("obs_id", "idx", "season", "price", *made)
    seven = rounded(rows, ["price"])
    seven = rounded(seven, [c for c in made if c != "disc_bal"], 7)
    return rounded(seven, ["disc_bal"], 8)


@query(
    "B11 H1",
    given(
        "engineered",
        "SELECT 'row_count' AS rule, CAST(count(*) AS DOUBLE) AS observed,"
        " count(*) = (SELECT count(*) FROM orders) AS passed FROM engineered"
        + "".join(
            f"\nUNION ALL SELECT 'has_{c}', 1.0, true" for c in ORDER_FEATURES.made
        )
        + """
        UNION ALL SELECT 'no_nulls', 0.0, true
        UNION ALL SELECT 'product_exact', CAST(count(*) FILTER (WHERE
            abs(qty_lines - qty * n_lines) > 1e-5 * abs(qty * n_lines)) AS DOUBLE),
            true FROM engineered""",
    ),
)
def engineered_contract(spark, folder):
    rows = engineered(spark, folder)
    expected = F.col("qty") * F.col("n_lines")
    wrong = F.count_if(F.abs(F.col("qty_lines") - expected) > F.abs(expected) * 1e-5)
    return clean.check_contract(
        rows,
        rows=table(spark, folder, "orders").count(),
        required=ORDER_FEATURES.made,
        no_nulls=rows.columns,
        extra={"product_exact": (wrong, wrong == 0)},
    )


@query(
    "G3",
    given(
        "filled",
        """SELECT obs_id,
           round((qty - min(qty) OVER ()) / (max(qty) OVER () - min(qty) OVER ()), 6) AS qty_scaled,
           round((price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER ()), 9)
             AS price_scaled,
           round(price, 4) AS price_restored FROM filled""",
    ),
)
def min_max_scaling(spark, folder):
    rows = clean.impute(staged(spark, folder, ["obs_id", "qty", "price"]), ["qty", "price"])
    qty, price = extremes(rows, "qty"), extremes(rows, "price")
    scaled = min_max_scaled(F.col("price"), *price)
    return rows.select(
        "obs_id",
        F.round(min_max_scaled(F.col("qty"), *qty), 6).alias("qty_scaled"),
        F.round(scaled, 9).alias("price_scaled"),
        F.round(min_max_restored(scaled, *price), 4).alias("price_restored"),
    )


@query(
    "G2",
    given(
        "filled size",
        "SELECT obs_id, "
        + ", ".join(
            f"round(({c} - (SELECT avg({c}) FROM filled, size WHERE idx < cut))"
            f" / (SELECT stddev_pop({c}) FROM filled, size WHERE idx < cut), 6) AS {c}"
            for c in ("qty", "price")
        )
        + " FROM filled",
    ),
)
def standard_scaling(spark, folder):
    rows = clean.impute(ordered(spark, folder, ["qty", "price"]), ["qty"])
    cut = splits.cut_position(rows.count(), 0.2)
    scaled = standardised(rows, ["qty", "price"], fit_on=F.col("idx") < cut)
    return rounded(scaled.select("obs_id", "qty", "price"), ["qty", "price"])


@query(
    "P9",
    given(
        "obs",
        """+ e AS (SELECT min(price) AS lo, max(price) AS hi FROM obs),
        placed AS (SELECT CAST(year AS VARCHAR) AS period,
                     least(CAST(floor((price - lo) / (hi - lo) * 10) AS INT) + 1, 10) AS bin,
                     count(*) AS n FROM obs, e GROUP BY 1, 2),
        periods AS (SELECT period, sum(n) AS total FROM placed GROUP BY 1),
        shares AS (
          SELECT p.period, b.bin, greatest(coalesce(n, 0) / total, 1e-6) AS share
          FROM periods p CROSS JOIN (SELECT unnest(range(1, 11)) AS bin) b
          LEFT JOIN placed q ON q.period = p.period AND q.bin = b.bin)
        SELECT s.period, round(sum((s.share - r.share) * ln(s.share / r.share)), 6) AS psi
        FROM shares s JOIN shares r ON r.bin = s.bin AND r.period = '1995' GROUP BY 1""",
    ),
)
def price_shift_by_year(spark, folder):
    rows = observations(spark, folder, ["year", "price"])
    return rounded(population_shift(rows, "price", "year", "1995"), ["psi"])


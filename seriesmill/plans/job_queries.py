"""Registered queries: the batch jobs end to end, from a written CSV file to published tables and saved models."""

from __future__ import annotations

import re
import uuid

from seriesmill.operators import learn, metrics
from seriesmill.operators.features import ORDER_FEATURES
from seriesmill.plans import jobs
from seriesmill.plans.check_sql import given
from seriesmill.plans.inputs import ordered, rounded, with_previous_price
from seriesmill.plans.model_queries import (
    _FEATURE_SQL,
    _FEATURES,
    _SCORE_SQL,
    DRIVERS,
    SEASONS,
    _rounded_scores,
    _spend_rows,
    _train,
)
from seriesmill.plans.model_sql import partialled
from seriesmill.plans.registry import query
from seriesmill.session import shared_folder
from seriesmill.sources.files import write_table
from seriesmill.sources.tables import ALL_COLUMNS, ORDER_KEYS


def _place(spark, label):
    """A folder of its own for the files of one run."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _preprocessed(spark, folder, place, kind="parquet"):
    """The observation table as a CSV file, put through the preprocess job; returns the engineered table."""
    rows = with_previous_price(ordered(spark, folder, [c for c in ALL_COLUMNS if c != "spend"])).drop("idx")
    write_table(rows, f"{place}/raw", "csv")
    return jobs.preprocess(
        spark, f"{place}/raw", f"{place}/engineered", ORDER_KEYS, fit_on_all=True, kind=kind, spec=ORDER_FEATURES, schema=rows.schema
    )


_MADE = ["previous_price", *ORDER_FEATURES.made]
_MADE_SQL = given(
    "engineered",
    "SELECT obs_id, idx, season, round(price, 6) AS price, "
    + ", ".join(f"round({c}, {8 if c == 'disc_bal' else 7}) AS {c}" for c in _MADE)
    + " FROM engineered",
)


def _shown(rows):
    seven = rounded(rounded(rows.select("obs_id", "idx", "season", "price", *_MADE), ["price"]), [c for c in _MADE if c != "disc_bal"], 7)
    return rounded(seven, ["disc_bal"], 8)


@query("A1 A2 H1 H2", _MADE_SQL)
def preprocess_job_output(spark, folder):
    """CSV in, parquet out and read back by its stated schema."""
    return _shown(_preprocessed(spark, folder, _place(spark, "job")))


@query("A1 A2 H2", _MADE_SQL)
def preprocess_job_csv_output(spark, folder):
    return _shown(_preprocessed(spark, folder, _place(spark, "job"), "csv"))


@query(
    "A3 A4 G4 G7",
    given(
        "obs",
        f"""+ spent AS (SELECT *, row_number() OVER (ORDER BY obs_ts, obs_id) - 1 AS i,
                           count(*) OVER () AS total FROM obs WHERE spend IS NOT NULL),
        t0 AS (SELECT spend AS actual, i < floor(total * 0.8) AS train, spend, {_FEATURE_SQL} FROM spent),
        """
        + partialled(_FEATURES, "spend", "actual")
        + f",\nways AS (SELECT unnest(['pipeline', 'table']) AS loaded)\nSELECT loaded, CASE WHEN train THEN 'train' ELSE 'test' END AS split,"
        f" {_SCORE_SQL} FROM fitted CROSS JOIN ways GROUP BY loaded, train",
    ),
)
def saved_model_scores(spark, folder):
    """A saved model, loaded once as a pipeline and once as its table of parameters: both must score as SQL does."""
    rows, path = _spend_rows(spark, folder), _place(spark, "model")
    learn.save(learn.fit(rows, learn.linear("spend"), DRIVERS, "season", _train()), path)
    ways = {"pipeline": learn.score(learn.load(path), rows), "table": learn.score_by_parameters(rows, learn.load_parameters(spark, path))}
    parts = [metrics.as_predictions(scored, name, "row", "spend", "predicted", split="split") for name, scored in ways.items()]
    found = metrics.regression_metrics(parts[0].unionByName(parts[1]), ["model", "split"])
    return _rounded_scores(found.withColumnRenamed("model", "loaded"))


#: All numeric columns of the engineered table but the target, then the season's dummies.
_JOB_FEATURES = [
    "year", "month", "day", "qty", "disc", "tax", "ext", "n_lines", "acctbal", *_MADE,
    *[f"season_{s}" for s in SEASONS],
]
_JOB_ROWS = (
    "+ t0 AS (SELECT qty AS amount, price AS actual, idx < (SELECT cut FROM size) AS train, price, "
    + ", ".join(f"CAST(season = '{c[7:]}' AS INT)::DOUBLE AS {c}" if c.startswith("season_") else f"{c}::DOUBLE AS {c}" for c in _JOB_FEATURES)
    + " FROM engineered),\n"
    + partialled(_JOB_FEATURES, "price", "amount, actual")
)
_MONTHS = """,
mo AS (SELECT *, idx < floor((SELECT count(*) FROM month_ord) * 0.8) AS train FROM month_ord),
"""


def _prefixed(sql: str, prefix: str) -> str:
    """The CTE chain of ``partialled`` under names of its own, so that several chains fit into one query."""
    return re.sub(r"\b(t0|means|fitted|[us]\d+)\b", rf"{prefix}\1", sql)


_AUTO = _prefixed(
    "d0 AS (SELECT *, price - lag(price) OVER (ORDER BY idx) AS c FROM mo),\n"
    "t0 AS (SELECT price AS actual, train, c, " + ", ".join(f"lag(c, {k}) OVER (ORDER BY idx) AS c{k}" for k in range(1, 6))
    + " FROM d0 QUALIFY c5 IS NOT NULL),\n" + partialled([f"c{k}" for k in range(1, 6)], "c", "actual", intercept=False),
    "a_",
)
_WINDOW = _prefixed(
    ",\nt0 AS (SELECT price AS actual, train, price, " + ", ".join(f"lag(price, {k}) OVER (ORDER BY idx) AS p{k}" for k in range(1, 13))
    + " FROM mo QUALIFY p12 IS NOT NULL),\n" + partialled([f"p{k}" for k in range(1, 13)], "price", "actual"),
    "w_",
)


@query(
    "H2 H3 H4 E8 A2 A3 A4 G4 G5 G10 G11",
    given(
        "engineered size month_ord",
        _JOB_ROWS + _MONTHS + _AUTO + _WINDOW + """,
        tested AS (SELECT 'linear' AS model, 'row' AS grain, actual, residual FROM fitted WHERE NOT train
                   UNION ALL SELECT 'autoregression(5,1,0)', 'month', actual, residual FROM a_fitted WHERE NOT train
                   UNION ALL SELECT 'window(12)', 'month', actual, residual FROM w_fitted WHERE NOT train)
        SELECT model, grain, count(*) AS n, round(sqrt(avg(residual * residual)), 2) AS rmse, round(avg(abs(residual)), 2) AS mae,
               round(1 - sum(residual * residual) / (var_pop(actual) * count(*)), 3) AS r2
        FROM tested GROUP BY model, grain""",
    ),
)
def trained_and_evaluated_jobs(spark, folder):
    """Preprocess, train and evaluate in a row, each from the files of the one before."""
    place = _place(spark, "job")
    _preprocessed(spark, folder, place)
    chosen = {"spec": ORDER_FEATURES, "row_models": ["linear"]}
    jobs.train(spark, f"{place}/engineered", f"{place}/models", folds=0, **chosen)
    found = jobs.evaluate(spark, f"{place}/engineered", f"{place}/models", **chosen).drop("mape_pct")
    return rounded(rounded(found, ["rmse", "mae"], 2), ["r2"], 3)


@query(
    "H5 H3 C10 E4",
    given(
        "engineered size",
        _JOB_ROWS + """
        SELECT CASE WHEN amount <= 100 THEN 'Low (<100)' WHEN amount <= 200 THEN 'Mid (100-200)' ELSE 'High (>200)' END AS qty_group,
               count(*) AS n, round(avg(abs(residual)), 3) AS mean_abs_error
        FROM fitted WHERE amount > 0 AND amount <= 300 GROUP BY 1""",
    ),
)
def error_report_job(spark, folder):
    place = _place(spark, "job")
    _preprocessed(spark, folder, place)
    jobs.train(spark, f"{place}/engineered", f"{place}/models", ORDER_FEATURES, folds=0, row_models=["linear"])
    report = jobs.error_report(
        spark, f"{place}/engineered", f"{place}/models", ORDER_FEATURES, "qty", [0, 100, 200, 300],
        ["Low (<100)", "Mid (100-200)", "High (>200)"], model="linear",
    )
    return rounded(report["error_by_bin"].withColumnRenamed("bin", "qty_group"), ["mean_abs_error"], 3)

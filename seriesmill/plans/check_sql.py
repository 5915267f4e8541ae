"""Named pieces of the check SQL; ``given`` puts the needed ones in front of a query."""

from __future__ import annotations

_OBS = """
obs AS (
  SELECT o.o_orderkey AS obs_id, o.o_orderdate AS obs_ts,
         CAST(year(o.o_orderdate) AS INT) AS year,
         CAST(month(o.o_orderdate) AS INT) AS month,
         CAST(day(o.o_orderdate) AS INT) AS day,
         CASE WHEN month(o.o_orderdate) IN (3, 4, 5) THEN 'Spring'
              WHEN month(o.o_orderdate) IN (6, 7, 8) THEN 'Summer'
              WHEN month(o.o_orderdate) IN (9, 10, 11) THEN 'Autumn'
              ELSE 'Winter' END AS season,
         o.o_totalprice AS price,
         l.qty, l.disc, l.tax, l.ext, l.n_lines, l.spend,
         c.c_mktsegment AS series_key, c.c_acctbal AS acctbal
  FROM orders o
  LEFT JOIN (
    SELECT l_orderkey, sum(l_quantity) AS qty, round(avg(l_discount), 6) AS disc,
           round(avg(l_tax), 6) AS tax, round(avg(l_extendedprice), 6) AS ext,
           CAST(count(*) AS DOUBLE) AS n_lines, round(sum(l_extendedprice), 2) AS spend
    FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey)"""

_ORD = """
ord AS (
  SELECT *, row_number() OVER (ORDER BY obs_ts, obs_id) - 1 AS idx,
         lag(price) OVER (ORDER BY obs_ts, obs_id) AS previous_price
  FROM obs)"""

_SIZE = """
size AS (
  SELECT count(*) AS n, CAST(floor(count(*) * (1 - 0.2)) AS BIGINT) AS cut FROM obs)"""

_FILLED = """
filled AS (
  SELECT obs_id, obs_ts, year, month, day, season, series_key, idx, price,
         coalesce(qty, (SELECT avg(qty) FROM ord)) AS qty,
         coalesce(disc, (SELECT avg(disc) FROM ord)) AS disc,
         coalesce(tax, (SELECT avg(tax) FROM ord)) AS tax,
         coalesce(ext, (SELECT avg(ext) FROM ord)) AS ext,
         coalesce(n_lines, (SELECT avg(n_lines) FROM ord)) AS n_lines,
         coalesce(acctbal, (SELECT avg(acctbal) FROM ord)) AS acctbal,
         coalesce(previous_price, (SELECT avg(previous_price) FROM ord)) AS previous_price
  FROM ord)"""

_ENGINEERED = """
engineered AS (
  SELECT *,
    coalesce(lag(previous_price) OVER w, previous_price) AS previous_lag,
    avg(qty) OVER (ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS qty_avg3,
    avg(disc) OVER (ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS disc_avg3,
    avg(ext) OVER (ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS ext_avg3,
    coalesce(tax - lag(tax) OVER w, lead(tax) OVER w - tax) AS tax_diff,
    coalesce(n_lines - lag(n_lines) OVER w, lead(n_lines) OVER w - n_lines) AS n_lines_trend,
    qty * n_lines AS qty_lines, disc * acctbal AS disc_bal,
    qty * disc AS qty_disc, acctbal * n_lines AS bal_lines
  FROM filled WHERE season IS NOT NULL WINDOW w AS (ORDER BY idx))"""

_MONTHLY = """
monthly AS (
  SELECT make_date(year, month, 1) AS month_start, avg(price) AS price, count(*) AS n
  FROM obs GROUP BY year, month)"""

_MONTH_ORD = """
month_ord AS (
  SELECT *, row_number() OVER (ORDER BY month_start) - 1 AS idx FROM monthly)"""

_PREDICTED = """
predicted AS (
  SELECT 'previous' AS model, CASE WHEN idx < cut THEN 'train' ELSE 'test' END AS split,
         idx, obs_id, year, month, day, season, qty, price AS actual, previous_price AS predicted
  FROM ord, size WHERE previous_price IS NOT NULL
  UNION ALL
  SELECT 'train_mean', CASE WHEN idx < cut THEN 'train' ELSE 'test' END,
         idx, obs_id, year, month, day, season, qty, price,
         (SELECT avg(price) FROM ord, size WHERE idx < cut)
  FROM ord, size)"""

_SCORED = """
scored AS (
  SELECT model, count(*) AS n,
         sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
         avg(abs(actual - predicted)) AS mae,
         avg(abs(actual - predicted) / greatest(abs(actual), 2.220446049250313e-16)) * 100
           AS mape_pct,
         1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) AS r2
  FROM predicted GROUP BY model)"""

_PIECES = {
    "obs": (_OBS, ()),
    "ord": (_ORD, ("obs",)),
    "size": (_SIZE, ("obs",)),
    "filled": (_FILLED, ("ord",)),
    "engineered": (_ENGINEERED, ("filled",)),
    "monthly": (_MONTHLY, ("obs",)),
    "month_ord": (_MONTH_ORD, ("monthly",)),
    "predicted": (_PREDICTED, ("ord", "size")),
    "scored": (_SCORED, ("predicted",)),
}


def given(names: str, body: str) -> str:
    """``body`` preceded by the named pieces and the pieces they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _PIECES[name][1]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    body = body.strip()
    pieces = ",".join(_PIECES[name][0] for name in ordered)
    return f"WITH {pieces[1:]}{',' if body.startswith('+') else ''}\n{body.lstrip('+').lstrip()}"

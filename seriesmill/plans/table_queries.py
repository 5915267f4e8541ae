"""Registered queries: scans, profiles, data quality, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.functions.columns import (
    half_even,
    month_start,
    numeric_columns,
    product,
    right_closed_bin,
    without_step_prefix,
)
from seriesmill.operators import aggregates, clean, correlation, profile
from seriesmill.operators.encode import label_codes, one_hot, standardised
from seriesmill.operators.features import ORDER_FEATURES
from seriesmill.operators.splits import cut_position
from seriesmill.plans.check_sql import given
from seriesmill.plans.inputs import (
    engineered,
    fixed_predictions,
    monthly_prices,
    ordered,
    rounded,
    staged,
)
from seriesmill.plans.registry import query
from seriesmill.sources.tables import ALL_COLUMNS, ORDER_KEYS, observations

MEASURES = ["price", "qty", "disc", "tax", "ext", "n_lines", "acctbal"]
CONTRACT_PRICE_RANGE = (500.0, 1_000_000.0)


def _per_column(template: str, columns=MEASURES) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in columns)


@query(
    "A1",
    given(
        "obs",
        """
        SELECT obs_id, year, month, day, season, series_key, price, qty, disc, tax, ext, n_lines,
               spend, acctbal
        FROM obs""",
    ),
)
def observation_table(spark, folder):
    return observations(spark, folder, [c for c in ALL_COLUMNS if c != "obs_ts"]).select(
        "obs_id", "year", "month", "day", "season", "series_key", "price", "qty", "disc", "tax",
        "ext", "n_lines", "spend", "acctbal",
    )


@query(
    "B1",
    """
    SELECT column_name,
           CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
                WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type,
           (SELECT count(*) FROM lineitem) AS rows
    FROM (DESCRIBE lineitem)""",
)
def table_shape(spark, folder):
    return profile.shape(spark.read.parquet(f"{folder}/lineitem.parquet"))


@query(
    "B2",
    given("obs", "SELECT obs_id, year, month, day, price FROM obs ORDER BY obs_ts, obs_id LIMIT 5"),
)
def first_rows(spark, folder):
    columns = ["obs_id", "obs_ts", "year", "month", "day", "price"]
    return profile.head(observations(spark, folder, columns), ORDER_KEYS).drop("obs_ts")


@query(
    "B3",
    given(
        "obs",
        _per_column(
            """SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
            round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
            round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM obs"""
        ),
    ),
)
def describe_measures(spark, folder):
    found = profile.describe(staged(spark, folder, MEASURES))
    return rounded(found, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@query(
    "B4",
    given(
        "obs",
        _per_column("SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM obs")
        + "\nUNION ALL SELECT '(total)', CAST(sum("
        + " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in MEASURES)
        + ") AS BIGINT) FROM obs",
    ),
)
def null_report(spark, folder):
    return clean.null_counts(observations(spark, folder, MEASURES))


@query(
    "B5 B6",
    given(
        "obs",
        _per_column(
            """SELECT '{c}' AS column_name, round(skewness({c}), 6) AS skewness,
            round(kurtosis({c}), 6) AS kurtosis FROM obs"""
        ),
    ),
)
def skewness_and_kurtosis(spark, folder):
    found = profile.distribution_shape(observations(spark, folder, MEASURES), MEASURES)
    return rounded(found, ["skewness", "kurtosis"])


@query(
    "B7",
    """SELECT round(avg(o_totalprice), 6) AS mean, round(median(o_totalprice), 6) AS median,
              min(o_totalprice) AS min, max(o_totalprice) AS max,
              round(stddev_samp(o_totalprice), 6) AS std FROM orders""",
)
def price_summary(spark, folder):
    found = profile.summary(observations(spark, folder, ["price"]), "price")
    return rounded(found, ["mean", "median", "std"])


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""
    edges AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}),
    placed AS (
      SELECT least(CAST(floor(({column} - lo) / (hi - lo) * {bins}) AS INT) + 1, {bins}) AS bin,
             count(*) AS n
      FROM {source}, edges WHERE {column} IS NOT NULL GROUP BY 1)
    SELECT CAST(b.bin AS INT) AS bin,
           round(lo + (b.bin - 1) * ((hi - lo) / {bins}), 6) AS lower,
           round(lo + b.bin * ((hi - lo) / {bins}), 6) AS upper,
           CAST(coalesce(n, 0) AS BIGINT) AS count
    FROM (SELECT unnest(range(1, {bins + 1})) AS bin) b LEFT JOIN placed USING (bin), edges"""


@query("B8", given("obs", "+" + _histogram_sql("obs", "price", 35)))
def price_histogram(spark, folder):
    found = profile.histogram(observations(spark, folder, ["price"]), "price", 35)
    return rounded(found, ["lower", "upper"])


@query(
    "B8 C11",
    given(
        "predicted",
        "+ residuals AS (SELECT round(actual - predicted, 2) AS residual FROM predicted"
        " WHERE model = 'previous'),"
        + _histogram_sql("residuals", "residual", 40),
    ),
)
def residual_histogram(spark, folder):
    rows = fixed_predictions(spark, folder).where(F.col("model") == "previous")
    residuals = rows.select(F.round(F.col("actual") - F.col("predicted"), 2).alias("residual"))
    return rounded(profile.histogram(residuals, "residual", 40), ["lower", "upper"])


@query(
    "B9",
    """
    WITH s AS (SELECT count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
                      stddev_samp(o_totalprice) * pow(count(*), -1.0 / 5) AS h FROM orders),
    grid AS (SELECT CAST(g AS INT) AS point, lo + g * ((hi - lo) / 199) AS x
             FROM (SELECT unnest(range(0, 200)) AS g), s)
    SELECT point, round(any_value(x), 4) AS x,
           round(sum(exp(-0.5 * pow((x - o_totalprice) / h, 2)))
                 / any_value(n * h * sqrt(2 * pi())) * 1000000, 6) AS density_per_million
    FROM grid, orders, s GROUP BY point""",
)
def price_density(spark, folder):
    found = profile.density(observations(spark, folder, ["price"]), "price")
    return found.select(
        "point",
        F.round("x", 4).alias("x"),
        F.round(F.col("density") * 1_000_000, 6).alias("density_per_million"),
    )


def _box_sql(long_rows: str, keys: str) -> str:
    return f"""
    long_rows AS ({long_rows}),
    boxes AS (
      SELECT {keys}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3
      FROM long_rows WHERE v IS NOT NULL GROUP BY {keys}),
    marked AS (
      SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM long_rows JOIN boxes USING ({keys}) WHERE v IS NOT NULL)
    SELECT {keys}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(min(CASE WHEN inside THEN v END), 6) AS whisker_low,
           round(max(CASE WHEN inside THEN v END), 6) AS whisker_high,
           count(*) FILTER (WHERE NOT inside) AS outliers
    FROM marked GROUP BY {keys}, q1, median, q3"""


BOX_NUMBERS = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@query(
    "B10",
    given(
        "obs",
        "+" + _box_sql(_per_column("SELECT '{c}' AS column_name, {c} AS v FROM obs"), "column_name"),
    ),
)
def measure_box_plots(spark, folder):
    return rounded(profile.box_plot(staged(spark, folder, MEASURES), MEASURES), BOX_NUMBERS)


@query("B10", given("obs", "+" + _box_sql("SELECT season, price AS v FROM obs", "season")))
def price_box_plot_by_season(spark, folder):
    rows = observations(spark, folder, ["season", "price"])
    found = profile.box_plot(rows, ["price"], by=["season"]).drop("column_name")
    return rounded(found, BOX_NUMBERS)


@query(
    "B10 G2",
    given(
        "filled",
        "+ z AS ("
        + _per_column(
            "SELECT '{c}' AS column_name, ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS v"
            " FROM filled"
        )
        + "),"
        + _box_sql("SELECT column_name, round(v, 9) AS v FROM z", "column_name"),
    ),
)
def scaled_box_plots(spark, folder):
    rows = clean.impute(staged(spark, folder, MEASURES))
    scaled = rounded(standardised(rows, MEASURES).select(*MEASURES), MEASURES, 9)
    return rounded(profile.box_plot(scaled, MEASURES), BOX_NUMBERS)


@query(
    "B11",
    given(
        "obs",
        f"""
        SELECT 'row_count' AS rule, CAST(count(*) AS DOUBLE) AS observed, count(*) = 15000 AS passed
        FROM obs
        UNION ALL SELECT 'column_count', 8.0, true
        UNION ALL SELECT 'has_season', 1.0, true
        UNION ALL SELECT 'has_rainfall', 0.0, false
        UNION ALL SELECT 'no_nulls', CAST(sum((CASE WHEN price IS NULL THEN 1 ELSE 0 END)
            + (CASE WHEN qty IS NULL THEN 1 ELSE 0 END)) AS DOUBLE),
            count(price) = count(*) AND count(qty) = count(*) FROM obs
        UNION ALL SELECT 'min_price', min(price), min(price) >= {CONTRACT_PRICE_RANGE[0]} FROM obs
        UNION ALL SELECT 'max_price', max(price), max(price) <= {CONTRACT_PRICE_RANGE[1]} FROM obs
        UNION ALL SELECT 'min_n_lines', min(n_lines), min(n_lines) >= 1 FROM obs
        UNION ALL SELECT 'max_n_lines', max(n_lines), max(n_lines) <= 7 FROM obs""",
    ),
)
def contract_report(spark, folder):
    rows = observations(spark, folder, ["season", *MEASURES])
    return clean.check_contract(
        rows,
        rows=15_000,
        columns=8,
        required=["season", "rainfall"],
        no_nulls=["price", "qty"],
        ranges={"price": CONTRACT_PRICE_RANGE, "n_lines": (1, 7)},
    )


@query(
    "C1 C2",
    given(
        "obs",
        "SELECT obs_id, year, month, day, qty, disc, tax, ext, n_lines, acctbal FROM obs",
    ),
)
def numeric_features(spark, folder):
    columns = [c for c in ALL_COLUMNS if c not in ("obs_ts", "spend")]
    rows = observations(spark, folder, columns)
    return rows.select(*numeric_columns(rows, exclude=("price",)))


@query("C3", given("obs", "SELECT obs_id, year, month, day, season, qty, price FROM obs"))
def named_columns(spark, folder):
    return observations(
        spark, folder, ["obs_id", "year", "month", "day", "season", "qty", "price"]
    )


@query(
    "C4",
    given(
        "filled",
        """SELECT obs_id, round(qty, 6) AS qty, round(disc, 6) AS disc, round(tax, 6) AS tax,
                  round(ext, 6) AS ext, round(n_lines, 6) AS n_lines FROM filled""",
    ),
)
def mean_imputation(spark, folder):
    columns = ["qty", "disc", "tax", "ext", "n_lines"]
    return rounded(clean.impute(staged(spark, folder, ["obs_id", *columns]), columns), columns)


@query(
    "C4",
    given(
        "ord size",
        """SELECT obs_id, round(coalesce(qty, (SELECT avg(qty) FROM ord, size WHERE idx < cut)), 6)
                  AS qty FROM ord""",
    ),
)
def mean_imputation_from_training_rows(spark, folder):
    rows = ordered(spark, folder, ["qty"])
    cut = cut_position(rows.count(), 0.2)
    return rounded(clean.impute(rows, ["qty"], fit_on=F.col("idx") < cut), ["qty"]).select(
        "obs_id", "qty"
    )


@query(
    "P2",
    given(
        "obs",
        """SELECT obs_id, round(coalesce(qty, (SELECT median(qty) FROM obs)), 6) AS qty,
           coalesce(n_lines, (SELECT n_lines FROM obs WHERE n_lines IS NOT NULL
                              GROUP BY n_lines ORDER BY count(*) DESC, n_lines LIMIT 1)) AS n_lines
           FROM obs""",
    ),
)
def median_and_mode_imputation(spark, folder):
    rows = staged(spark, folder, ["obs_id", "qty", "n_lines"])
    filled = clean.impute(rows, ["qty"], strategy="median")
    return rounded(clean.impute(filled, ["n_lines"], strategy="mode"), ["qty"])


@query(
    "C5",
    given("obs", "SELECT obs_id, price, qty, disc FROM obs WHERE qty IS NOT NULL AND disc IS NOT NULL"),
)
def complete_rows(spark, folder):
    return clean.drop_incomplete(observations(spark, folder, ["obs_id", "price", "qty", "disc"]))


@query(
    "C6",
    given(
        "filled",
        """SELECT obs_id, round(qty * n_lines, 8) AS qty_lines, round(disc * acctbal, 8) AS disc_bal,
                  round(qty * disc, 8) AS qty_disc, round(acctbal * n_lines, 8) AS bal_lines
           FROM filled""",
    ),
)
def interaction_terms(spark, folder):
    rows = clean.impute(
        staged(spark, folder, ["obs_id", "qty", "disc", "n_lines", "acctbal"]),
        ["qty", "disc", "n_lines", "acctbal"],
    )
    terms = {new: product(*pair) for new, pair in ORDER_FEATURES.products.items()}
    return rounded(rows.withColumns(terms).select("obs_id", *terms), list(terms), 8)


@query(
    "C7",
    given("obs", "SELECT obs_id, make_date(year, month, 1) AS month_start FROM obs"),
)
def month_of_each_row(spark, folder):
    rows = observations(spark, folder, ["obs_id", "year", "month"])
    return rows.select("obs_id", month_start(F.col("year"), F.col("month")).alias("month_start"))


@query(
    "C8",
    """SELECT l_quantity / 2 AS half_quantity, round_even(l_quantity / 2, 0) AS to_whole,
              round_even(l_quantity / 8, 2) AS to_cents, count(*) AS rows
       FROM lineitem GROUP BY l_quantity""",
)
def half_even_rounding(spark, folder):
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_quantity")
    quantity = F.col("l_quantity")
    return rows.agg(F.count(F.lit(1)).alias("rows")).select(
        (quantity / 2).alias("half_quantity"),
        half_even(quantity / 2, 0).alias("to_whole"),
        half_even(quantity / 8, 2).alias("to_cents"),
        "rows",
    )


BINS = ([0, 100, 200, 300], ["low", "mid", "high"])
_BIN_SQL = """CASE WHEN qty > 0 AND qty <= 100 THEN 'low' WHEN qty > 100 AND qty <= 200 THEN 'mid'
              WHEN qty > 200 AND qty <= 300 THEN 'high' END"""


@query("C10", given("obs", f"SELECT obs_id, qty, {_BIN_SQL} AS qty_bin FROM obs"))
def quantity_bins(spark, folder):
    rows = observations(spark, folder, ["obs_id", "qty"])
    return rows.withColumn("qty_bin", right_closed_bin(F.col("qty"), *BINS))


@query(
    "C12",
    given(
        "obs",
        _per_column("SELECT '{c}' AS feature, round(avg({c}), 6) AS mean FROM obs")
        + """
        UNION ALL SELECT 'season_' || season,
          round(count(*) / (SELECT count(*) FROM obs), 6) FROM obs GROUP BY season""",
    ),
)
def cleaned_feature_names(spark, folder):
    rows = observations(spark, folder, ["season", *MEASURES])
    encoded = one_hot(rows, "season", drop="none")
    dummies = [c for c in encoded.columns if c.startswith("season_")]
    packed = [
        F.struct(F.lit(f"{step}__{c}").alias("name"), F.avg(c).alias("mean"))
        for step, names in (("scale", MEASURES), ("cat", dummies))
        for c in names
    ]
    means = encoded.agg(F.array(*packed).alias("_all")).select(F.inline("_all"))
    return means.select(
        without_step_prefix(F.col("name")).alias("feature"), F.round("mean", 6).alias("mean")
    )


@query(
    "C13",
    given(
        "obs",
        """SELECT season, round(sum(price), 2) AS total,
                  round(sum(price) / sum(sum(price)) OVER () * 100, 6) AS pct
           FROM obs GROUP BY season""",
    ),
)
def season_share_of_revenue(spark, folder):
    totals = observations(spark, folder, ["season", "price"]).groupBy("season")
    totals = totals.agg(F.sum("price").alias("total"))
    return aggregates.with_share(totals, "total").select(
        "season", F.round("total", 2).alias("total"), F.round("pct", 6).alias("pct")
    )


@query(
    "C14 G1",
    given(
        "obs",
        """SELECT obs_id, season,
                  CASE WHEN season = 'Spring' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS season_Spring,
                  CASE WHEN season = 'Summer' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS season_Summer,
                  CASE WHEN season = 'Winter' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS season_Winter
           FROM obs""",
    ),
)
def season_dummies(spark, folder):
    return one_hot(observations(spark, folder, ["obs_id", "season"]), "season", drop="first")


@query(
    "P3",
    given(
        "obs",
        """SELECT obs_id, CAST(dense_rank() OVER (ORDER BY season) - 1 AS INT) AS season_code
           FROM obs""",
    ),
)
def season_label_codes(spark, folder):
    rows = observations(spark, folder, ["obs_id", "season"])
    return label_codes(rows, "season", "season_code").select("obs_id", "season_code")


@query(
    "E1 F1",
    given("monthly", "SELECT month_start, round(price, 6) AS price, n FROM monthly ORDER BY 1"),
)
def monthly_mean_price(spark, folder):
    return rounded(monthly_prices(spark, folder), ["price"]).orderBy("month_start")


@query(
    "E1",
    given(
        "obs",
        """SELECT series_key, make_date(year, month, 1) AS month_start,
                  round(avg(price), 6) AS price, count(*) AS n
           FROM obs GROUP BY series_key, year, month""",
    ),
)
def monthly_mean_price_by_segment(spark, folder):
    return rounded(monthly_prices(spark, folder, ["series_key"]), ["price"])


@query(
    "E1",
    """
    WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, o_custkey,
                      avg(o_totalprice) AS price, count(*) AS n FROM orders GROUP BY 1, 2),
    calendar AS (
      SELECT o_custkey, CAST(unnest(generate_series(CAST(min(month_start) AS TIMESTAMP),
             CAST(max(month_start) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month_start
      FROM m GROUP BY o_custkey)
    SELECT o_custkey, month_start, round(price, 6) AS price, CAST(coalesce(n, 0) AS BIGINT) AS n
    FROM calendar LEFT JOIN m USING (o_custkey, month_start)""",
)
def monthly_price_by_customer_with_gaps(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        "o_custkey",
        "o_totalprice",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    months = aggregates.monthly_mean(orders, "o_totalprice", keys=["o_custkey"], fill_gaps=True)
    return rounded(months, ["price"])


@query(
    "E12",
    given(
        "monthly",
        """SELECT count(*) AS months, min(month_start) AS first_month,
                  max(month_start) AS last_month FROM monthly""",
    ),
)
def monthly_series_extent(spark, folder):
    return aggregates.series_extent(monthly_prices(spark, folder))


@query(
    "E2",
    given(
        "obs",
        """SELECT CAST(o.ordinal AS INT) AS ordinal, o.season, round(avg(price), 6) AS mean,
                  round(stddev_samp(price), 6) AS std
           FROM (VALUES (1, 'Spring'), (2, 'Summer'), (3, 'Monsoon'), (4, 'Autumn'), (5, 'Winter'))
                o(ordinal, season) LEFT JOIN obs ON obs.season = o.season
           GROUP BY 1, 2""",
    ),
)
def price_by_season(spark, folder):
    order = ["Spring", "Summer", "Monsoon", "Autumn", "Winter"]
    rows = observations(spark, folder, ["season", "price"])
    return rounded(aggregates.category_stats(rows, "season", "price", order), ["mean", "std"])


@query(
    "E3",
    given(
        "obs",
        """SELECT year, round(avg(price), 6) AS mean, round(stddev_samp(price), 6) AS std,
                  round(avg(price) - stddev_samp(price), 6) AS lower,
                  round(avg(price) + stddev_samp(price), 6) AS upper
           FROM obs GROUP BY year""",
    ),
)
def price_by_year(spark, folder):
    rows = observations(spark, folder, ["year", "price"])
    return rounded(aggregates.yearly_band(rows, "price"), ["mean", "std", "lower", "upper"])


RAW_NUMBERS = ["year", "month", "day", *MEASURES]


@query(
    "E5",
    given(
        "obs",
        _per_column(
            "SELECT '{c}' AS column_name, round(corr({c}, spend), 6) AS corr FROM obs",
            [*RAW_NUMBERS, "spend"],
        ),
    ),
)
def correlation_with_spend(spark, folder):
    rows = observations(spark, folder, [*RAW_NUMBERS, "spend"])
    return rounded(correlation.correlation_with(rows, "spend"), ["corr"]).orderBy(
        F.desc("corr"), "column_name"
    )


ENGINEERED_NUMBERS = [*RAW_NUMBERS, "previous_price", *ORDER_FEATURES.made]


@query(
    "E5 F2",
    given(
        "engineered",
        "SELECT * FROM ("
        + _per_column(
            "SELECT '{c}' AS column_name, round(corr({c}, price), 6) AS corr FROM engineered",
            ENGINEERED_NUMBERS,
        )
        + ") ORDER BY corr DESC, column_name LIMIT 10",
    ),
)
def strongest_correlations(spark, folder):
    found = correlation.correlation_with(engineered(spark, folder), "price", ENGINEERED_NUMBERS)
    return correlation.strongest(rounded(found, ["corr"]), 10)


@query(
    "C9",
    given(
        "engineered",
        "+ before AS ("
        + _per_column("SELECT '{c}' AS c, corr({c}, spend) AS r FROM obs", RAW_NUMBERS)
        + "), after AS ("
        + _per_column(
            "SELECT '{c}' AS c, corr({c}, o.spend) AS r"
            " FROM (SELECT e.*, s.spend FROM engineered e JOIN obs s USING (obs_id)) o",
            ENGINEERED_NUMBERS,
        )
        + """)
        SELECT 'before' AS stage, count(*) FILTER (WHERE abs(r) > 0.05) AS columns_above FROM before
        UNION ALL
        SELECT 'after', count(*) FILTER (WHERE abs(r) > 0.05) FROM after""",
    ),
)
def correlated_columns_before_and_after(spark, folder):
    raw = observations(spark, folder, [*RAW_NUMBERS, "spend"])
    before = correlation.correlation_with(raw, "spend", RAW_NUMBERS)
    made = engineered(spark, folder).join(
        observations(spark, folder, ["obs_id", "spend"]), "obs_id"
    )
    after = correlation.correlation_with(made, "spend", ENGINEERED_NUMBERS)
    counted = [
        correlation.count_above(found, "spend").select(F.lit(name).alias("stage"), "columns_above")
        for name, found in (("before", before), ("after", after))
    ]
    return counted[0].unionByName(counted[1])


def _matrix_sql(source: str, columns) -> str:
    rows = [
        f"SELECT '{row}' AS row_name, '{column}' AS column_name,"
        f" round(corr({row}, {column}), 6) AS corr FROM {source}"
        for i, column in enumerate(columns)
        for row in columns[i + 1 :]
    ]
    return "\nUNION ALL\n".join(rows)


@query("E6", given("obs", _matrix_sql("obs", MEASURES)))
def correlation_triangle(spark, folder):
    rows = observations(spark, folder, MEASURES)
    return rounded(correlation.correlation_matrix(rows, MEASURES), ["corr"])


@query("E6", given("engineered", _matrix_sql("engineered", ENGINEERED_NUMBERS)))
def engineered_correlation_triangle(spark, folder):
    found = correlation.correlation_matrix(engineered(spark, folder), ENGINEERED_NUMBERS)
    return rounded(found, ["corr"])

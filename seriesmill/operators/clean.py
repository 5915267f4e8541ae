"""Null handling and data contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.columns import numeric_columns
from seriesmill.operators.quantiles import exact_quantiles


def fill_values(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    strategy: str = "mean",
    fit_on: Column | None = None,
) -> dict[str, float]:
    """Fill value of each column that has nulls, as driver numbers.

    The statistic is taken over the rows where ``fit_on`` holds (all by default).
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    fitted = {c: F.col(c) if fit_on is None else F.when(fit_on, F.col(c)) for c in columns}
    wanted = [F.count_if(F.col(c).isNull()).alias(f"{c} nulls") for c in columns]
    if strategy == "mean":
        wanted += [F.avg(fitted[c]).alias(c) for c in columns]
    found = df.agg(*wanted).first().asDict()
    lacking = [c for c in columns if found[f"{c} nulls"]]
    rows = df if fit_on is None else df.where(fit_on)
    if strategy == "median":
        middle = exact_quantiles(rows, lacking, [0.5]).collect() if lacking else []
        found = {row["column_name"]: row["value"] for row in middle}
    elif strategy == "mode":
        found = {c: _mode(rows, c) for c in lacking}
    elif strategy != "mean":
        raise ValueError("strategy is 'mean', 'median' or 'mode'")
    return {c: found[c] for c in lacking if found.get(c) is not None}


def _mode(df: DataFrame, column: str):
    """Most frequent known value, the smallest one on ties."""
    top = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .count()
        .orderBy(F.desc("count"), F.asc(column))
        .first()
    )
    return None if top is None else top[column]


def impute(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    strategy: str = "mean",
    fit_on: Column | None = None,
) -> DataFrame:
    """Replace nulls of numeric columns by a statistic of the column.

    Columns without nulls stay as they are; an integer column filled with a mean or
    median becomes double. Pass ``fit_on`` (for example ``col("idx") < cut``) to keep
    later rows out of the statistic.
    """
    values = fill_values(df, columns, strategy, fit_on)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the rows without any null."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column and a ``(total)`` row, from one pass."""
    names = df.columns
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    total = reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in names])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("nulls")) for c in names]
    pairs.append(F.struct(F.lit("(total)").alias("column_name"), total.alias("nulls")))
    return counts.select(F.inline(F.array(*pairs)))


def check_contract(
    df: DataFrame,
    rows: int | None = None,
    columns: int | None = None,
    required: Sequence[str] = (),
    no_nulls: Sequence[str] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    extra: Mapping[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Evaluate all rules in one aggregation: (rule, observed, passed).

    ``extra`` maps a rule name to (aggregate shown as observed, aggregate that is
    true when the rule holds).
    """
    rules: list[tuple[str, Column, Column]] = []
    count = F.count(F.lit(1))
    if rows is not None:
        rules.append(("row_count", count, count == rows))
    if columns is not None:
        rules.append(("column_count", F.lit(len(df.columns)), F.lit(len(df.columns) == columns)))
    for name in required:
        present = name in df.columns
        rules.append((f"has_{name}", F.lit(int(present)), F.lit(present)))
    if no_nulls is not None:
        nulls = reduce(
            lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in no_nulls], F.lit(0)
        )
        rules.append(("no_nulls", nulls, nulls == 0))
    for name, (low, high) in (ranges or {}).items():
        if name not in df.columns:
            rules.append((f"range_{name}", F.lit(None), F.lit(False)))
            continue
        rules.append((f"min_{name}", F.min(name), F.coalesce(F.min(name) >= low, F.lit(False))))
        rules.append((f"max_{name}", F.max(name), F.coalesce(F.max(name) <= high, F.lit(False))))
    for name, (observed, passed) in (extra or {}).items():
        rules.append((name, observed, F.coalesce(passed, F.lit(False))))
    packed = [
        F.struct(
            F.lit(name).alias("rule"),
            observed.cast("double").alias("observed"),
            passed.alias("passed"),
        )
        for name, observed, passed in rules
    ]
    return df.agg(F.array(*packed).alias("_rules")).select(F.inline("_rules"))

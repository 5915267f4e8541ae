"""Pearson correlations and cross-product sums."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions.columns import numeric_columns
from seriesmill.functions.moments import pearson

WIDE = 6  # from this many columns on, pairs are summed as matrix products


def correlation_with(
    df: DataFrame, target: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """(column_name, corr) of each numeric column with the target, from one pass.

    Each pair uses the rows where both values are known. The target itself (1.0) is kept.
    """
    columns = list(columns or numeric_columns(df))
    found = _correlations(df, [(c, target) for c in columns])
    return found.select(F.col("x").alias("column_name"), "corr")


def strongest(correlations: DataFrame, k: int = 10) -> DataFrame:
    """The k largest correlations, ties by name."""
    return correlations.orderBy(F.desc("corr"), F.asc("column_name")).limit(k)


def count_above(correlations: DataFrame, target: str, threshold: float = 0.05) -> DataFrame:
    """One row: how many columns other than the target exceed the threshold in size."""
    others = correlations.where(F.col("column_name") != target)
    return others.agg(F.count_if(F.abs("corr") > threshold).alias("columns_above"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(row_name, column_name, corr): the strict lower triangle, pairwise complete."""
    columns = list(columns or numeric_columns(df))
    found = _correlations(df, [(row, column) for column, row in combinations(columns, 2)])
    return found.select(F.col("x").alias("row_name"), F.col("y").alias("column_name"), "corr")


def _correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(x, y, corr) for each pair of columns."""
    columns = list(dict.fromkeys(name for pair in pairs for name in pair))
    # NaN is unknown, whichever way the pairs are summed.
    df = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    if len(columns) >= WIDE:
        return _by_products(df, columns, pairs)
    packed = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), pearson(x, y).alias("corr"))
        for x, y in pairs
    ]
    return df.agg(F.array(*packed).alias("_all")).select(F.inline("_all"))


def _by_products(df: DataFrame, columns: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """All pairs by matrix products per Arrow batch; one row per pair and task is shuffled.

    Each task returns counts, means and centred sums of its rows. They are merged with
    the means over all tasks, so large offsets do not cancel digits.
    """
    left = np.array([columns.index(x) for x, _ in pairs])
    right = np.array([columns.index(y) for _, y in pairs])
    width = len(columns)
    names = ["n", "mx", "my", "cxx", "cyy", "cxy"]
    schema = "pair int, " + ", ".join(f"{name} double" for name in names)

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, totals = None, np.zeros((6, len(left)))
        for batch in batches:
            matrix = np.column_stack(
                [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
            )
            known = ~np.isnan(matrix)
            ones = known.astype("float64")
            if shift is None:  # any value near the mean will do
                shift = np.where(known, matrix, 0.0).sum(0) / np.maximum(ones.sum(0), 1)
            values = np.where(known, matrix - shift, 0.0)
            sums = values.T @ ones  # [i, j]: sum of i where j is known
            squares = (values * values).T @ ones
            both = ones.T @ ones
            cross = values.T @ values
            totals += [
                both[left, right],
                sums[left, right],
                sums[right, left],
                squares[left, right],
                squares[right, left],
                cross[left, right],
            ]
        pair = np.flatnonzero(totals[0] > 0)
        if shift is None or not len(pair):
            return
        n, sx, sy, sxx, syy, sxy = totals[:, pair]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(pair.astype("int32")),
                pa.array(n),
                pa.array(shift[left[pair]] + sx / n),
                pa.array(shift[right[pair]] + sy / n),
                pa.array(np.maximum(sxx - sx * sx / n, 0.0)),
                pa.array(np.maximum(syy - sy * sy / n, 0.0)),
                pa.array(sxy - sx * sy / n),
            ],
            names=["pair", *names],
        )

    parts = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInArrow(
        products, schema
    )
    # One row per pair and task: a group is as long as the number of tasks.
    tasks = Window.partitionBy("pair")

    def overall(mean: str):
        return F.sum(F.col("n") * F.col(mean)).over(tasks) / F.sum("n").over(tasks)

    off = parts.withColumns(
        {"dx": F.col("mx") - overall("mx"), "dy": F.col("my") - overall("my")}
    )
    merged = off.groupBy("pair").agg(
        F.sum(F.col("cxx") + F.col("n") * F.col("dx") * F.col("dx")).alias("cxx"),
        F.sum(F.col("cyy") + F.col("n") * F.col("dy") * F.col("dy")).alias("cyy"),
        F.sum(F.col("cxy") + F.col("n") * F.col("dx") * F.col("dy")).alias("cxy"),
    )
    every = df.sparkSession.createDataFrame(
        [(i, x, y) for i, (x, y) in enumerate(pairs)], "pair int, x string, y string"
    )
    spread = F.sqrt(F.col("cxx")) * F.sqrt(F.col("cyy"))
    return every.join(merged, "pair", "left").select(
        "x", "y", F.try_divide(F.col("cxy"), F.nullif(spread, F.lit(0.0))).alias("corr")
    )


def cross_products(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """(keys.., n, gram): sums of products of all column pairs over complete rows.

    ``gram`` is the upper triangle, row by row. Sums are combined before the
    shuffle, so a key with many rows costs one row per task.
    """
    complete = df.na.drop("any", subset=list(columns))
    sums = [
        F.sum(F.col(a) * F.col(b)) for a, b in combinations_with_replacement(list(columns), 2)
    ]
    return complete.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*sums).alias("gram")
    )

"""Least squares on many rows by QR: every task reduces its rows to one small triangle, triangles merge as a tree.

The rows [1, features, target] of a task become the R factor of their QR decomposition, a batch at a time. R factors of
different rows are stacked and decomposed again, which needs no normal equations and so keeps the digits of nearly
dependent columns. Factors of consecutive position ranges are merged to prefixes: one pass over the rows fits all expanding folds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.splits import fold_bounds

#: Triangles that one task of the first merge takes.
FAN_IN = 64


def triangle(*parts: np.ndarray) -> np.ndarray:
    """R factor of stacked rows or triangles, with as many rows as columns at most."""
    return np.linalg.qr(np.vstack(parts), mode="r")


def _reduce(columns: Sequence[str]):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        part = None
        for batch in source:
            values = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            rows = np.column_stack([np.ones(len(batch)), *values])
            rows, segments = rows[~np.isnan(rows).any(axis=1)], batch.column("_segment").to_numpy()[~np.isnan(rows).any(axis=1)]
            part = batch.column("_part")[0].as_py() if len(batch) else part
            for segment in np.unique(segments):
                mine = rows[segments == segment]
                held[int(segment)] = triangle(held[int(segment)], mine) if int(segment) in held else triangle(mine)
        yield _as_rows(held, [part or 0] * len(held))

    return run


def _as_rows(held: dict[int, np.ndarray], parts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int64()), pa.array(parts, pa.int64()), pa.array([r.reshape(-1).tolist() for r in held.values()], pa.list_(pa.float64()))],
        ["_segment", "_part", "r"],
    )


def _merge(width: int):
    def run(key, table):
        parts = [np.array(r).reshape(-1, width) for r in table.column("r").to_pylist()]
        return pa.Table.from_batches([_as_rows({key[0].as_py(): triangle(*parts)}, [key[1].as_py()])])

    return run


def r_factors(df: DataFrame, features: Sequence[str], target: str, segment: Column) -> dict[int, np.ndarray]:
    """R factor of [1, features, target] for each segment; rows with a null or NaN are left out."""
    columns = [f"_{i}" for i in range(len(features) + 1)]
    numbers = [F.col(c).cast("double").alias(n) for c, n in zip([*features, target], columns)]
    schema = "_segment long, _part long, r array<double>"
    rows = df.select(segment.cast("long").alias("_segment"), F.spark_partition_id().cast("long").alias("_part"), *numbers).where("_segment IS NOT NULL")
    factors, merge = rows.mapInArrow(_reduce(columns), schema), _merge(len(columns) + 1)
    groups = factors.withColumn("_part", F.expr(f"_part div {FAN_IN}")).groupBy("_segment", "_part").applyInArrow(merge, schema)
    whole = groups.withColumn("_part", F.lit(0).cast("long")).groupBy("_segment", "_part").applyInArrow(merge, schema)
    return {r["_segment"]: np.array(r["r"]).reshape(-1, len(columns) + 1) for r in whole.collect()}  # k x k each


def coefficients(r: np.ndarray) -> np.ndarray:
    """Intercept and slopes; of dependent columns the shortest answer in units of their length."""
    left, right = r[:, :-1], r[:, -1]
    length = np.linalg.norm(left, axis=0)
    length[length == 0] = 1.0
    return np.linalg.lstsq(left / length, right, rcond=1e-12)[0] / length


def value(features: Sequence[str], found: np.ndarray) -> Column:
    total = F.lit(float(found[0]))
    for name, slope in zip(features, found[1:]):
        total = total + F.col(name) * float(slope)
    return total


def fit(df: DataFrame, features: Sequence[str], target: str, fit_on: Column | None = None) -> np.ndarray:
    """Intercept and slopes on the rows where ``fit_on`` holds; zeros without a complete row."""
    used = F.lit(0) if fit_on is None else F.when(fit_on, 0)
    factors = r_factors(df, features, target, used)
    return coefficients(factors[0]) if factors else np.zeros(len(features) + 1)


def cross_validate(
    df: DataFrame, features: Sequence[str], target: str, folds: int = 5, idx: str = "idx", out: str = "predicted", rows: int | None = None
) -> DataFrame:
    """Test predictions of expanding-window folds, with ``fold``: all folds are fitted in one pass."""
    bounds = fold_bounds(df.count() if rows is None else rows, folds)
    position = F.col(idx)
    segment = sum(((position >= start).cast("int") for _, start, _ in bounds), F.lit(0))
    # The last range is tested only.
    factors = r_factors(df, features, target, F.when(position < bounds[-1][1], segment))
    prefix, fold, predicted = [], F.lit(None).cast("int"), F.lit(None).cast("double")
    for number, start, end in bounds:
        prefix += [factors[number - 1]] if number - 1 in factors else []
        inside = (position >= start) & (position < end)
        found = coefficients(triangle(*prefix)) if prefix else np.zeros(len(features) + 1)
        fold, predicted = F.when(inside, number).otherwise(fold), F.when(inside, value(features, found)).otherwise(predicted)
    return df.where(position >= bounds[0][1]).withColumns({"fold": fold, out: predicted}).where("fold IS NOT NULL")

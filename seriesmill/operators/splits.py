"""Splits and folds that keep time order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.aggregates import with_share
from seriesmill.operators.order import is_dense, with_position


def compact_position(df: DataFrame, idx: str = "idx") -> DataFrame:
    """Renumber positions from 0 without gaps after rows were dropped; a no-op if dense."""
    if is_dense(df, idx):
        return df
    return with_position(df.withColumnRenamed(idx, "_old"), ["_old"], idx).drop("_old")


def cut_position(rows: int, fraction: float) -> int:
    """First test position: the part before it, truncated to whole rows, is for training."""
    return int(rows * (1 - fraction))


def temporal_split(df: DataFrame, fraction: float = 0.2, idx: str = "idx") -> DataFrame:
    """Add ``split``: 'train' for the first part of the order, 'test' for the last ``fraction``."""
    cut = cut_position(df.count(), fraction)
    return df.withColumn("split", F.when(F.col(idx) < cut, "train").otherwise("test"))


def random_split(
    df: DataFrame, fraction: float = 0.2, seed: int = 42, key: str = "idx"
) -> DataFrame:
    """Add ``split`` by a hash of ``key``, for measuring how much such a split leaks. Not for evaluation.

    A row keeps its side whatever the partition layout and however often it is computed.
    """
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 8)
    drawn = F.conv(digits, 16, 10).cast("double") / float(1 << 32)
    return df.withColumn("split", F.when(drawn < fraction, "test").otherwise("train"))


def fold_bounds(rows: int, folds: int = 5) -> list[tuple[int, int, int]]:
    """(fold, test_start, test_end) of expanding-window folds; training is all before test_start."""
    size = rows // (folds + 1)
    if size < 1:
        raise ValueError("more folds than rows")
    first = rows - folds * size
    return [(k + 1, first + k * size, first + (k + 1) * size) for k in range(folds)]


def expanding_folds(df: DataFrame, folds: int = 5, idx: str = "idx") -> DataFrame:
    """One row per (row, fold it takes part in), with ``fold`` and ``role`` (train or test)."""
    bounds = F.array(
        *[
            F.struct(F.lit(k).alias("fold"), F.lit(a).alias("start"), F.lit(b).alias("end"))
            for k, a, b in fold_bounds(df.count(), folds)
        ]
    )
    used = F.filter(bounds, lambda fold: F.col(idx) < fold["end"])
    role = F.when(F.col(idx) < F.col("_fold.start"), "train").otherwise("test")
    return (
        df.withColumn("_fold", F.explode(used))
        .withColumns({"fold": F.col("_fold.fold"), "role": role})
        .drop("_fold")
    )


def fold_segment(bounds: list[tuple[int, int, int]], idx: str = "idx") -> Column:
    """The fold a row is tested in; 0 for rows that are only trained on. Fold k is trained on the segments before k."""
    return sum(((F.col(idx) >= start).cast("int") for _, start, _ in bounds), F.lit(0))


_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def fold_aggregates(
    df: DataFrame, wanted: Mapping[str, tuple[str, Column]], folds: int = 5, idx: str = "idx", rows: int | None = None
) -> DataFrame:
    """(fold, role, name..) of expanding folds without a copy of any row.

    ``wanted`` maps names to a merge ("sum", "min" or "max") and a value per row. Rows are aggregated to folds + 1 segments;
    the training part of a fold is what its earlier segments merge to. ``rows`` saves the count if it is known.
    """
    bounds = fold_bounds(df.count() if rows is None else rows, folds)
    segments = df.groupBy(fold_segment(bounds, idx).alias("_segment")).agg(
        *[_MERGE[how](value).alias(name) for name, (how, value) in wanted.items()]
    )
    # folds + 1 rows from here on: each counts for its own test and for the training of all later folds.
    used = segments.select("*", F.explode(F.sequence(F.greatest("_segment", F.lit(1)), F.lit(folds))).alias("fold"))
    role = F.when(F.col("fold") == F.col("_segment"), "test").otherwise("train")
    return used.groupBy("fold", role.alias("role")).agg(*[_MERGE[how](name).alias(name) for name, (how, _) in wanted.items()])


def split_by_target(
    windows: DataFrame, rows: int, train_share: float = 0.9, idx: str = "idx"
) -> DataFrame:
    """Add ``split`` (train / val) to supervised windows by the position of their target.

    A validation window may look back into the training part, as one made from an
    overlapping slice would; no row is duplicated for it.
    """
    return windows.withColumn(
        "split", F.when(F.col(idx) < int(rows * train_share), "train").otherwise("val")
    )


def split_report(df: DataFrame, target: str, idx: str = "idx") -> DataFrame:
    """(split, rows, first_idx, last_idx, min_target, max_target, pct) per split."""
    return with_share(
        df.groupBy("split").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(idx).alias("first_idx"),
            F.max(idx).alias("last_idx"),
            F.min(target).alias("min_target"),
            F.max(target).alias("max_target"),
        ),
        "rows",
    )


def leakage_check(
    df: DataFrame, fraction: float = 0.2, idx: str = "idx", time: str | None = None
) -> DataFrame:
    """One row: whether all training rows precede all test rows, and whether sizes are as asked."""
    order = time or idx
    train, test = F.col("split") == "train", F.col("split") == "test"
    expected = F.floor(F.count(F.lit(1)) * (1 - fraction))
    ordered = F.max(F.when(train, F.col(order))) <= F.min(F.when(test, F.col(order)))
    positions = F.max(F.when(train, F.col(idx))) < F.min(F.when(test, F.col(idx)))
    return df.agg(
        F.count_if(train).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        (positions & ordered).alias("in_order"),
        (F.abs(F.count_if(train) - expected) <= 1).alias("sizes_ok"),
    )


def oversample(df: DataFrame, column: str, low: float, high: float, factor: int) -> DataFrame:
    """Repeat the rows with rare values (below ``low`` or above ``high``) ``factor`` times."""
    rare = (F.col(column) < low) | (F.col(column) > high)
    copies = F.when(rare, F.lit(factor)).otherwise(F.lit(1))
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))

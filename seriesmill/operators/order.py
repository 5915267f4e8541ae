"""Row positions in a total order, and windows over that order without a hot partition.

A window that is ordered but not partitioned runs in one task, and a window
partitioned by a key runs each key in one task. Neither holds for a long series
or a hot key. Here the order is made explicit once (``with_position``), and
windows then run per block of consecutive positions. Every block also gets copies
of the few rows before and after it that its frames can reach, so results at block
edges are the same as in one long window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesmill.session import stage

BLOCK_ROWS = 65_536
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in 33 bits


def with_position(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "idx"
) -> DataFrame:
    """Add the dense 0-based position of each row in ``order_by`` order.

    ``order_by`` must be a total order. Rows are range-partitioned on it and
    sorted, and the rows with their place (partition, row in partition) are staged.
    The offsets of the partitions, one row per partition, are then added. Range
    bounds come from a sample of whole keys, so a date or key that holds a large
    part of the rows is split over partitions like any other range.
    """
    placed = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        "position",
    )
    partition = F.shiftright("_place", _LOCAL_BITS)
    sizes = placed.groupBy(partition.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition of the range shuffle: small enough for one task and to broadcast.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    local = F.col("_place").bitwiseAND((1 << _LOCAL_BITS) - 1)
    return (
        placed.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + local)
        .drop("_part", "_offset", "_place")
    )


def block_of(position: str, block_rows: int) -> Column:
    """Number of the block that holds a position."""
    return F.expr(f"{position} div {block_rows}")


def over_blocks(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    back: int,
    ahead: int = 0,
    keys: Sequence[str] = (),
    idx: str = "idx",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window columns whose frames reach at most ``back`` / ``ahead`` rows.

    ``build`` receives the window (ordered by ``idx``, without a frame) and returns
    the columns to add; all of them share one shuffle and one sort. With ``keys``,
    ``idx`` must come from an order that starts with the keys; frames then stop at
    the edges of each key.
    """
    if block_rows <= max(back, ahead):
        raise ValueError("blocks must be longer than the frames")
    first = block_of(f"greatest({idx} - {ahead}, 0)", block_rows)
    last = block_of(f"({idx} + {back})", block_rows)
    copies = df.withColumn("_block", F.explode(F.sequence(first, last)))
    window = Window.partitionBy("_block", *keys).orderBy(idx)
    return (
        copies.withColumns(build(window))
        .where(F.col("_block") == block_of(idx, block_rows))
        .drop("_block")
    )


def over_series(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    order_by: Sequence[str],
    back: int,
    ahead: int = 0,
    keys: Sequence[str] = (),
    largest: int = BLOCK_ROWS,
) -> DataFrame:
    """Window columns per series, for rows that have no position yet.

    The rows per key are counted first. While the largest series fits a block, one
    shuffle by key does; otherwise the rows get positions and the windows run over
    blocks, which cut the large series apart.
    """
    if keys:
        size = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if size <= largest:
            return df.withColumns(build(Window.partitionBy(*keys).orderBy(*order_by)))
    placed = with_position(df, [*keys, *order_by], "_idx")
    return over_blocks(
        placed, build, back, ahead, keys, "_idx", max(largest, back + ahead + 1)
    ).drop("_idx")


def join_series(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a per-series table; a null key is a series of its own."""
    right = other.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = reduce(
        lambda a, b: a & b, [df[key].eqNullSafe(right[f"_right_{key}"]) for key in keys]
    )
    return df.join(right, condition, "left").drop(*[f"_right_{key}" for key in keys])


def nearest_known(
    df: DataFrame,
    columns: Sequence[str],
    direction: str,
    keys: Sequence[str] = (),
    idx: str = "idx",
    block_rows: int = BLOCK_ROWS,
    suffix: str = "_filled",
) -> DataFrame:
    """Fill nulls from the nearest known value at or after (``next``) or before (``last``) the row."""
    if direction not in ("next", "last"):
        raise ValueError("direction is 'next' or 'last'")
    rows, series = _with_series(df, keys)
    found = _known(rows, columns, direction == "next", series, idx, block_rows, suffix, own=True)
    return found.drop(*series)


def _with_series(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, tuple[str, ...]]:
    """Pack the keys in one column: structs compare equal field by field, nulls included.

    Window and join then use the same columns, so the join needs no second shuffle.
    """
    return (df.withColumn("_series", F.struct(*keys)), ("_series",)) if keys else (df, ())


def _known(
    df: DataFrame,
    columns: Sequence[str],
    ahead: bool,
    keys: Sequence[str],
    idx: str,
    block_rows: int,
    suffix: str,
    own: bool,
) -> DataFrame:
    """Nearest known value in one direction, counting the row's own value if ``own``.

    The distance to that value has no bound, so copies at block edges are not
    enough: each block is reduced to the known value nearest to its neighbour, that
    short table is solved the same way, and rows look up what their block lacks.
    """
    toward = F.desc if ahead else F.asc

    def seen(frame: DataFrame, groups: Sequence[str], position: str, own: bool) -> DataFrame:
        window = Window.partitionBy(*groups).orderBy(toward(position))
        window = window.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
        return frame.withColumns(
            {f"{c}{suffix}": F.last(c, ignorenulls=True).over(window) for c in columns}
        )

    if _blocks(df, idx, block_rows) <= 1:
        return seen(df, keys, idx, own)
    groups = ("_block", *keys)
    edge = F.min_by if ahead else F.max_by
    block = block_of(idx, block_rows).alias("_block")
    edges = df.groupBy(block, *keys).agg(
        *[edge(c, F.when(F.col(c).isNotNull(), F.col(idx))).alias(c) for c in columns]
    )
    outside = _known(
        edges.withColumnRenamed("_block", "_at"), columns, ahead, keys, "_at", block_rows, "_", False
    ).select(F.col("_at").alias("_block"), *keys, *[F.col(f"{c}_").alias(f"_{c}") for c in columns])
    inside = seen(df.withColumn("_block", block), groups, idx, own)
    return (
        inside.join(outside, list(groups), "left")
        .withColumns({f"{c}{suffix}": F.coalesce(f"{c}{suffix}", f"_{c}") for c in columns})
        .drop("_block", *[f"_{c}" for c in columns])
    )


def _blocks(df: DataFrame, idx: str, block_rows: int) -> int:
    """How many blocks the positions span."""
    if block_rows < 2:
        raise ValueError("a block has at least two rows")
    last = df.agg(F.max(idx)).first()[0]
    return 0 if last is None else last // block_rows + 1


def running_total(
    df: DataFrame,
    column: str,
    out: str,
    keys: Sequence[str] = (),
    idx: str = "idx",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Cumulative sum in position order: sums inside blocks plus the totals of earlier blocks."""
    rows, series = _with_series(df, keys)
    return _total(rows, column, out, series, idx, block_rows, own=True).drop(*series)


def _total(df, column, out, keys, idx, block_rows, own) -> DataFrame:
    def summed(frame: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
        window = Window.partitionBy(*groups).orderBy(idx)
        window = window.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
        return frame.withColumn(name, F.coalesce(F.sum(column).over(window), F.lit(0)))

    if _blocks(df, idx, block_rows) <= 1:
        return summed(df, keys, out)
    groups = ("_block", *keys)
    earlier, here = f"_earlier_{out}", f"_here_{out}"
    block = block_of(idx, block_rows).alias("_block")
    totals = df.groupBy(block, *keys).agg(F.sum(column).alias("_sum"))
    carried = _total(
        totals.withColumnRenamed("_block", "_at"), "_sum", earlier, keys, "_at", block_rows, False
    ).select(F.col("_at").alias("_block"), *keys, earlier)
    inside = summed(df.withColumn("_block", block), groups, here)
    return (
        inside.join(carried, list(groups), "left")
        .withColumn(out, F.coalesce(earlier, F.lit(0)) + F.col(here))
        .drop("_block", here, earlier)
    )


def is_dense(df: DataFrame, idx: str = "idx") -> bool:
    """Whether positions run from 0 to n-1 without gaps."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.max(idx).alias("last")).first()
    return row["n"] == 0 or row["n"] == row["last"] + 1

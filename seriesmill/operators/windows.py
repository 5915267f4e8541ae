"""Time-series columns: lags, rolling means, differences, fills and supervised windows.

All functions take rows that carry a position column (see ``order.with_position``).
Frames count rows; only ``change_since`` looks back by time, and takes rows without a position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from seriesmill.operators.order import BLOCK_ROWS, nearest_known, over_blocks, running_total, with_position


def lag_with_head(name: str, window: WindowSpec) -> Column:
    """Value of the previous row; the first row, which has none, takes the next lag (its own value).

    Equal to shift-then-back-fill for a column without nulls.
    """
    return F.coalesce(F.lag(name, 1).over(window), F.col(name))


def difference_with_head(name: str, window: WindowSpec) -> Column:
    """Change from the previous row; the first row takes the second row's change.

    Equal to difference-then-back-fill for a column without nulls.
    """
    change = F.col(name) - F.lag(name, 1).over(window)
    return F.coalesce(change, F.lead(name, 1).over(window) - F.col(name))


def rolling_mean(name: str, window: WindowSpec, rows: int = 3) -> Column:
    """Mean of the known values among this row and the ``rows - 1`` before it."""
    return F.avg(name).over(window.rowsBetween(1 - rows, 0))


def lagged(
    df: DataFrame, columns: Sequence[str], steps: int = 1, head: str = "back", **where
) -> DataFrame:
    """Add ``<column>_lag``. ``head='null'`` leaves the first rows empty.

    ``head='back'`` fills what is missing from the next known lag, also after nulls within a column.
    """
    if head == "back" and steps == 1 and (holes := _with_nulls(df, columns)):
        rest = [c for c in columns if c not in holes]
        out = lagged(df, holes, 1, "null", **where)
        out = _filled_back(out, [f"{c}_lag" for c in holes], **where)
        return lagged(out, rest, 1, head, **where) if rest else out

    def build(window: WindowSpec) -> dict[str, Column]:
        if head == "back":
            if steps != 1:
                raise ValueError("head='back' is defined for one step")
            return {f"{c}_lag": lag_with_head(c, window) for c in columns}
        return {f"{c}_lag": F.lag(c, steps).over(window) for c in columns}

    return over_blocks(df, build, back=steps, **where)


def rolled(df: DataFrame, columns: Sequence[str], rows: int = 3, **where) -> DataFrame:
    """Add ``<column>_avg``, the rolling mean over ``rows`` rows."""
    return over_blocks(
        df,
        lambda window: {f"{c}_avg": rolling_mean(c, window, rows) for c in columns},
        back=rows - 1,
        **where,
    )


def differenced(df: DataFrame, columns: Sequence[str], head: str = "back", **where) -> DataFrame:
    """Add ``<column>_diff``, the first difference; ``head='back'`` fills it from the next known one."""
    if head == "back" and (holes := _with_nulls(df, columns)):
        rest = [c for c in columns if c not in holes]
        out = differenced(df, holes, "null", **where)
        out = _filled_back(out, [f"{c}_diff" for c in holes], **where)
        return differenced(out, rest, head, **where) if rest else out

    def build(window: WindowSpec) -> dict[str, Column]:
        if head == "back":
            return {f"{c}_diff": difference_with_head(c, window) for c in columns}
        return {f"{c}_diff": F.col(c) - F.lag(c, 1).over(window) for c in columns}

    return over_blocks(df, build, back=1, ahead=1, **where)


def _with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    found = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if found[c]]


def _filled_back(df: DataFrame, columns: Sequence[str], **where) -> DataFrame:
    """Replace nulls of the columns by the next known value of the series."""
    filled = nearest_known(df, columns, "next", **where)
    kept = [c for c in df.columns if c not in columns]
    return filled.select(*kept, *[F.col(f"{c}_filled").alias(c) for c in columns])


def nth_difference(df: DataFrame, column: str, order: int, out: str, **where) -> DataFrame:
    """Add the ``order``-fold difference as a sum of lags with binomial weights."""

    def build(window: WindowSpec) -> dict[str, Column]:
        weight, total = 1, F.col(column)
        for step in range(1, order + 1):
            weight = -weight * (order - step + 1) // step
            total = total + F.lit(weight) * F.lag(column, step).over(window)
        return {out: total}

    return over_blocks(df, build, back=max(order, 1), **where)


def undo_difference(
    df: DataFrame, start: str, change: str, out: str, **where
) -> DataFrame:
    """Levels from changes: the level ``start`` of the first row plus the running sum of changes.

    ``start`` holds the level on the first row of a series and null or zero elsewhere.
    """
    steps = df.withColumn(
        "_step", F.coalesce(F.col(change), F.lit(0.0)) + F.coalesce(F.col(start), F.lit(0.0))
    )
    return running_total(steps, "_step", out, **where).drop("_step")


def velocity(df: DataFrame, column: str, steps: Sequence[int] = (7, 30), **where) -> DataFrame:
    """Add ``<column>_velocity_<k>``: the change over the last k rows."""
    return over_blocks(
        df,
        lambda window: {
            f"{column}_velocity_{k}": F.col(column) - F.lag(column, k).over(window) for k in steps
        },
        back=max(steps),
        **where,
    )


def change_since(
    df: DataFrame, column: str, at: str, tie: str, days: Sequence[int] = (7, 30), keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``<column>_change_<d>d``: the value less the last known one of at least d days before the row's time.

    ``tie`` is unique and orders rows of the same time. The look-back has no bound in rows or time: for every row and d a
    probe is put at the earlier time, after all rows of that time; rows and probes get one order, and
    probes take the nearest known value before them by blocks. Null where nothing is known so early; a null time gives null.
    """
    own = [*keys, F.col(at).alias("_at"), F.col(tie).alias("_tie")]
    rows = df.where(F.col(at).isNotNull()).select(*own, F.lit(0).alias("_days"), F.col(column).alias("_value"))
    spans = F.explode(F.array(*[F.lit(d) for d in days]))
    probes = df.where(F.col(at).isNotNull()).select(*own, spans.alias("_days"))
    probes = probes.withColumns({"_at": F.col("_at") - F.make_dt_interval("_days"), "_value": F.lit(None).cast(df.schema[column].dataType)})
    probes = probes.withColumn("_at", F.col("_at").cast(df.schema[at].dataType))
    placed = with_position(rows.unionByName(probes), [*keys, "_at", "_days", "_tie"], "_idx")
    seen = nearest_known(placed, ["_value"], "last", keys, "_idx").where("_days > 0")
    earlier = seen.groupBy("_tie").agg(*[F.max(F.when(F.col("_days") == d, F.col("_value_filled"))).alias(f"_{d}") for d in days])
    changes = {f"{column}_change_{d}d": F.col(column) - F.col(f"_{d}") for d in days}
    return df.join(earlier, F.col(tie) == F.col("_tie"), "left").withColumns(changes).drop("_tie", *[f"_{d}" for d in days])


def future_targets(df: DataFrame, column: str, horizons: Sequence[int] = (1, 2, 3), **where):
    """Add ``<column>_ahead_<h>``: the value h rows later, null at the end of the series."""
    return over_blocks(
        df,
        lambda window: {f"{column}_ahead_{h}": F.lead(column, h).over(window) for h in horizons},
        back=1,
        ahead=max(horizons),
        **where,
    )


def lag_names(length: int, prefix: str = "lag") -> list[str]:
    """Names of the window slots, oldest first."""
    return [f"{prefix}_{step}" for step in range(length, 0, -1)]


def supervised_windows(
    df: DataFrame,
    columns: Sequence[str],
    length: int = 12,
    as_array: bool = False,
    idx: str = "idx",
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the ``length`` previous values of each column; rows without a full past are dropped.

    One column per slot (``lag_12`` .. ``lag_1``; with several inputs
    ``<column>_lag_12`` ..), or one array column ``window`` (per input
    ``<column>_window``), oldest first. Nulls keep their slot.
    """

    def build(window: WindowSpec) -> dict[str, Column]:
        made: dict[str, Column] = {
            "_past": F.count(F.lit(1)).over(window.rowsBetween(-length, -1))
        }
        for column in columns:
            prefix = "lag" if len(columns) == 1 else f"{column}_lag"
            slots = {
                name: F.lag(column, step).over(window)
                for name, step in zip(lag_names(length, prefix), range(length, 0, -1))
            }
            if as_array:
                name = "window" if len(columns) == 1 else f"{column}_window"
                made[name] = F.array(*slots.values())
            else:
                made.update(slots)
        return made

    made = over_blocks(df, build, back=length, keys=keys, idx=idx, block_rows=block_rows)
    return made.where(F.col("_past") == length).drop("_past")

"""Columns of the input out of the way of an operator's own column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: All other columns stand in one under this name, so an input column of any name is safe, also of this one.
REST = "columns that go along"


def packed(frame: DataFrame, *needed: str) -> DataFrame:
    """``needed`` columns as they are, and all others in one struct."""
    others = [F.col(f"`{c}`") for c in frame.columns if c not in needed]
    return frame.select(*needed, F.struct(*others, *([] if others else [F.lit(0).alias("none")])).alias(REST))


def unpacked(frame: DataFrame, columns: Sequence[str], needed: Sequence[str]) -> DataFrame:
    """The columns of the input in their order; those needed with their present values."""
    return frame.select(*[F.col(c) if c in needed else F.col(REST).getField(c).alias(c) for c in columns])

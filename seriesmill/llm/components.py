"""Connected components of links by contraction, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.session import stage


def _parents(links: DataFrame) -> DataFrame:
    """Point each larger end to its smallest neighbour and follow the pointers to their roots."""
    pointers = stage(links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), "pointers")
    while True:
        above = pointers.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = pointers.join(above, "root", "left").select(
            "node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")
        )
        jumped = stage(jumped, "pointers")
        pointers = jumped.select("node", "root")
        if not jumped.filter("moved").head(1):
            return pointers


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns ``a`` and ``b``); component is its smallest node.

    Each round hooks every node to its smallest neighbour, jumps to the roots and contracts the
    links between roots, so a hub costs one row per task and a chain a logarithm of its length.
    Nodes without links are not returned; links with a null end and loops are ignored.
    """
    def between(frame: DataFrame) -> DataFrame:
        return stage(frame.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "links")

    left = between(links)
    roots = None
    while left.head(1):
        pointers = _parents(left)
        if roots is None:
            roots = pointers
        else:
            moved = pointers.select(F.col("node").alias("root"), F.col("root").alias("newer"))
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("newer", "root").alias("root"))
            roots = stage(roots.unionByName(pointers).distinct(), "roots")
        ends = [pointers.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")) for side in ("lo", "hi")]
        contracted = left.join(ends[0], "lo", "left").join(ends[1], "hi", "left")
        left = between(contracted.select(F.coalesce("lo_root", "lo").alias("a"), F.coalesce("hi_root", "hi").alias("b")))
    if roots is None:
        return left.select(F.col("lo").alias("node"), F.col("hi").alias("component"))
    own = roots.select(F.col("root").alias("node"), "root")
    return roots.unionByName(own).groupBy("node").agg(F.min("root").alias("component"))

"""Cumulative-snapshot collapse of logged conversations, DataFrame functions only.

A log often holds a conversation again after every turn. A conversation is dropped if its turns are the first turns of a
longer one, or the same as those of one with a smaller id. Every turn is hashed with its place, and the sums of these hashes up
to each turn identify every prefix; whole conversations are anti-joined with the prefixes of longer ones. Prefixes that many
conversations share are aggregated to one row first, so a common opening adds one row per task.

Running sums of a conversation are taken over blocks of turns (by quotient of the place), so a conversation with a third of all rows
is spread over many tasks. Rendering is by turn: each kept turn gets its own piece of the template text and its place,
and ``rendered`` joins pieces to texts of at most ``TURNS`` turns.

The order of turns is that of ``turn``, then role and text; nulls come first and equal each other, so repeated turns count as turns. A
null ``conv_id`` is dropped. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.session import stage

TURNS = 256
BLOCK = 4096
#: Fixed values of the template.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, place): place counts the turns of a conversation from 1.

    Turn numbers cut a conversation into blocks; counts of earlier blocks are added to the place within the block.
    """
    rows = turns.filter("conv_id IS NOT NULL").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.withColumn("block", F.coalesce(F.expr(f"turn div {BLOCK}"), F.lit(-(1 << 62))))
    sizes = rows.groupBy("conv_id", "block").count()
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    joined = rows.join(sizes, (rows.conv_id == F.col("_c")) & (rows.block == F.col("_b")))
    return joined.select("conv_id", "turn", "role", "text", (F.col("before") + F.row_number().over(inside)).alias("place"))


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, place, h1, h2): two 64-bit hashes of the turns up to each place."""
    seeds = {"h1": 7, "h2": 1_000_003}
    hashed = {
        name: F.xxhash64(F.lit(seed), "place", F.coalesce("role", F.lit("")), F.col("role").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull())
        for name, seed in seeds.items()
    }
    # Sums of decimals do not overflow; only equality matters.
    rows = rows.select("conv_id", "place", *[h.cast("decimal(20,0)").alias(n) for n, h in hashed.items()])
    rows = rows.withColumn("block", F.expr(f"place div {BLOCK}"))
    sums = rows.groupBy("conv_id", "block").agg(*[F.sum(n).alias(f"{n}_sum") for n in seeds])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    sums = sums.select(
        F.col("conv_id").alias("_c"), F.col("block").alias("_b"), *[F.coalesce(F.sum(f"{n}_sum").over(earlier).cast("decimal(38,0)"), zero).alias(f"{n}_before") for n in seeds]
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(sums, (rows.conv_id == F.col("_c")) & (rows.block == F.col("_b")))
    return joined.select(
        "conv_id", "place", *[(F.sum(n).over(inside).cast("decimal(38,0)") + F.col(f"{n}_before")).cast("decimal(38,0)").alias(n) for n in seeds]
    )


def judged(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, verdicts): the numbered turns, and (conv_id, n_turns, kept) of every conversation."""
    rows = stage(numbered(turns), "turns")
    sums = stage(prefixes(rows), "prefixes")
    whole = sums.groupBy("conv_id").agg(F.max("place").alias("place"), F.max_by(F.struct("h1", "h2"), "place").alias("h"))
    whole = stage(whole.select("conv_id", "place", "h.h1", "h.h2"), "whole")
    lengths = whole.select(F.col("conv_id").alias("_id"), F.col("place").alias("length"))
    longest = sums.join(lengths, F.col("conv_id") == F.col("_id")).groupBy("place", "h1", "h2").agg(
        F.max("length").alias("longest"), F.min(F.when(F.col("length") == F.col("place"), F.col("conv_id"))).alias("first_id")
    )
    covers = longest.select(
        F.col("place").alias("_p"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "longest", "first_id"
    )
    same = (F.col("place") == F.col("_p")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    covered = same & ((F.col("longest") > F.col("place")) | (F.col("first_id") < F.col("conv_id")))
    maximal = stage(whole.join(covers, covered, "left_anti").select(F.col("conv_id").alias("_kept")), "maximal")
    verdicts = whole.join(maximal, F.col("conv_id") == F.col("_kept"), "left").select(
        "conv_id", F.col("place").cast("long").alias("n_turns"), F.col("_kept").isNotNull().alias("kept")
    )
    return rows, verdicts


def pieces(turns: DataFrame) -> DataFrame:
    """(conv_id, place, n_turns, piece) of every turn of the maximal conversations."""
    rows, verdicts = judged(turns)
    piece = F.concat(F.lit(BEGIN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(END), F.lit("\n"))
    kept = verdicts.filter("kept").select(F.col("conv_id").alias("_id"), "n_turns")
    return rows.join(kept, F.col("conv_id") == F.col("_id")).select("conv_id", "place", "n_turns", piece.alias("piece"))


def rendered(turns: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, text) of the maximal conversations: part counts from 0, a part has at most TURNS turns."""
    rows = pieces(turns).withColumn("part", F.expr(f"(place - 1) div {TURNS}"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "piece")))
    texts = rows.groupBy("conv_id", "part", "n_turns").agg(F.array_join(F.transform(ordered, lambda x: x["piece"]), "").alias("text"))
    return texts.select("conv_id", "part", "n_turns", "text")


SQL = """
WITH numbered AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
pieces AS (
  SELECT conv_id, place, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS piece FROM numbered),
grown AS (
  SELECT conv_id, place, string_agg(piece, '' ORDER BY place) OVER (PARTITION BY conv_id ORDER BY place) AS so_far FROM pieces),
whole AS (SELECT conv_id, max(place) AS n_turns, max_by(so_far, place) AS text FROM grown GROUP BY conv_id),
covered AS (
  SELECT DISTINCT w.conv_id FROM whole w JOIN grown g ON g.place = w.n_turns AND g.so_far = w.text JOIN whole o ON o.conv_id = g.conv_id
  WHERE o.n_turns > w.n_turns OR (o.n_turns = w.n_turns AND o.conv_id < w.conv_id))
SELECT w.conv_id, CAST((p.place - 1) // 256 AS BIGINT) AS part, w.n_turns, string_agg(p.piece, '' ORDER BY p.place) AS text
FROM whole w JOIN pieces p USING (conv_id) WHERE w.conv_id NOT IN (SELECT conv_id FROM covered) GROUP BY 1, 2, 3
"""

"""Mixing by iterative proportional fitting, DataFrame functions only.

Token weights of the cells (one for each combination of source, language and topic that occurs) are raked to
marginal targets: in turn, each dimension's weights are scaled so that its categories have their target shares.
The factor of a cell, weight over tokens, is its calibration; documents are sampled with probabilities in
proportion to it, scaled to an expected share of all tokens and limited to 1 (cells at 1 pass their part on to the others).
A document's draw is a hash of its id, so it is the same in every run and on every partition layout.

Documents are aggregated to cells before anything else; rounds touch cells only. Null categories form a category of their own.
A null or empty text has no tokens and goes with its cell; repeated rows of a document are drawn together; a document with a null
id is drawn by the hash of an empty id. Other columns stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.packing import packed, unpacked
from seriesmill.session import stage

DIMENSIONS = ("source", "lang", "topic")
#: Targets are the own shares raised to this power (1 keeps them, 0 makes all categories equal).
FLATTEN = 0.5
KEEP = 0.5
ROUNDS_PER_STAGE = 5
#: Shares this near to their targets are met; rounds that leave more than this part of the gap no longer help.
TOLERANCE, SLOWEST = 1e-9, 0.999


def n_tokens(text: Column) -> Column:
    """Words between white space; the ends of the text are no words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def layout_topic(text: Column) -> Column:
    """The documents carry no topic; their layout stands for one: marked-up, short, middle or long prose."""
    size = F.length(F.coalesce(text, F.lit("")))
    marks = size - F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[|%$#*&!<>{}]", ""))
    return F.when(20 * marks > size, "marked").when(size < 600, "short").when(size < 3000, "middle").otherwise("long")


def flattened_targets(cells: DataFrame, dimensions: Sequence[str], power: float) -> dict[str, DataFrame]:
    """For each dimension its categories with shares in proportion to their tokens raised to ``power``."""
    out = {}
    for name in dimensions:
        sums = cells.groupBy(name).agg(F.sum("tokens").alias("held"))
        raised = F.pow(F.col("held").cast("double"), F.lit(float(power)))
        out[name] = sums.filter("held > 0").select(F.col(name), (raised / F.sum(raised).over(Window.partitionBy())).alias("share"))
    return out


def _largest_gap(cells: DataFrame, targets: dict[str, DataFrame]) -> float:
    """How far the worst category's share is from its target; targets of absent categories do not count."""
    parts = [
        cells.groupBy(name).agg(F.abs(F.sum("weight") / F.first("total") - F.coalesce(F.first(f"_share_{name}"), F.lit(0.0))).alias("gap")).select("gap")
        for name in targets
    ]
    return reduce(DataFrame.unionAll, parts).agg(F.max("gap")).head()[0] or 0.0 if parts else 0.0


def raked(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """The cells with a column ``weight``: their tokens fitted to the target shares, in all the tokens of the cells.

    Rounds go on until every share is within ``TOLERANCE`` of its target. Categories without a target get no weight.
    Where targets contradict, so that rounds stop bringing them nearer, the last dimension is met and a warning
    says how far off the others stay.
    """
    total = F.sum("tokens").over(Window.partitionBy()).cast("double")
    out = cells.filter("tokens > 0").withColumn("total", total).withColumn("weight", F.col("tokens").cast("double"))
    for name, shares in targets.items():
        renamed = shares.select(F.col(name).alias("_category"), F.col("share").alias(f"_share_{name}"))
        out = out.join(renamed, out[name].eqNullSafe(F.col("_category")), "left").drop("_category")
    out, last = stage(out, "cells"), None
    while True:
        for _ in range(ROUNDS_PER_STAGE):
            for name in targets:
                held = F.sum("weight").over(Window.partitionBy(name))
                fitted = F.col("weight") * F.coalesce(F.col(f"_share_{name}"), F.lit(0.0)) * F.col("total") / held
                out = out.withColumn("weight", F.when(held > 0, fitted).otherwise(0.0))
        out = stage(out, "raked")
        gap = _largest_gap(out, targets)
        if gap <= TOLERANCE:
            break
        if last is not None and gap > SLOWEST * last:
            warnings.warn(f"targets contradict the cells: a share stays {gap:.2g} off its target", stacklevel=2)
            break
        last = gap
    return out.select(*cells.columns, "weight")


def probabilities(cells: DataFrame, keep: float) -> DataFrame:
    """The raked cells with ``factor`` (weight over tokens) and ``probability``, so that about ``keep`` of all tokens stay."""
    cells = stage(cells.withColumn("factor", F.round(F.col("weight") / F.col("tokens"), 9)), "factors")
    all_tokens = cells.agg(F.sum("tokens")).head()[0]
    scale = keep
    # Every step but the last finds further cells full, so the steps end.
    while all_tokens:
        full = F.col("factor") * scale >= 1
        held = cells.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("factor"))).alias("rest"),
        ).head()
        if not held["rest"] or held["full"] >= keep * all_tokens:
            break
        needed = (keep * all_tokens - held["full"]) / held["rest"]
        if needed <= scale * (1 + 1e-12):
            break
        scale = needed
    return cells.withColumn("probability", F.round(F.least(F.lit(1.0), F.col("factor") * scale), 6))


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(16**12)


def mixed(
    docs: DataFrame, dimensions: Sequence[str] = DIMENSIONS, targets: dict[str, DataFrame] | None = None, keep: float = KEEP
) -> DataFrame:
    """The documents (with all dimension columns) and n_tokens, factor, probability, kept."""
    counted = docs.withColumn("n_tokens", n_tokens(F.col("text")))
    cells = counted.groupBy(*dimensions).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    cells = stage(cells, "token-cells")
    fitted = probabilities(raked(cells, targets or flattened_targets(cells, dimensions, FLATTEN)), keep)
    keys = [F.col(name).alias(f"_{name}") for name in dimensions]
    factors = stage(fitted.select(*keys, "factor", "probability"), "probabilities")
    same = [counted[name].eqNullSafe(F.col(f"_{name}")) for name in dimensions]
    out = counted.join(F.broadcast(factors) if factors.count() <= 100_000 else factors, same, "left")
    out = out.drop(*[f"_{name}" for name in dimensions])
    # Cells without any token have no weight to fit: their documents cost nothing and stay.
    out = out.withColumns({"factor": F.coalesce("factor", F.lit(1.0)), "probability": F.coalesce("probability", F.lit(1.0))})
    return out.withColumn("kept", draw(F.col("doc_id")) < F.col("probability"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, factor, probability, kept) of every document."""
    shown = docs.select("doc_id", "text", "source", "lang", layout_topic(F.col("text")).alias("topic"))
    return mixed(shown).drop("text")


def sampled(docs: DataFrame) -> DataFrame:
    """The documents drawn, with their columns as they were."""
    needed = [c for c in ("doc_id", "text", *DIMENSIONS) if c in docs.columns]
    shown = packed(docs, *needed)
    if "topic" not in needed:
        shown = shown.withColumn("topic", layout_topic(F.col("text")))
    return unpacked(mixed(shown).filter("kept"), docs.columns, needed)

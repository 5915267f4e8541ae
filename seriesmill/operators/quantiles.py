"""Exact interpolated quantiles without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.session import lookup, stage

EXACT_ROWS = 4_000_000
#: The sketch's rank error is one part in so many of all values.
ACCURACY = 10_000
_BINS = 4096
_LARGEST = 1.7976931348623157e308


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """(by.., column_name, probability, value) with linear interpolation between order statistics.

    The built-in exact percentile keeps all distinct values of a group in one
    task. It is used while no group has more than ``exact_rows`` values (rows times
    columns). Beyond that a mergeable sketch with a known rank error gives a bracket around each wanted order
    statistic; a second pass counts what is below and inside each bracket, a third writes out the few values inside,
    and those are ranked. Brackets that are still long are narrowed by counts over bins. Columns stay side by side in all
    three passes, so the table is never copied to one row per value.
    """
    # NaN is no value here, as null is not.
    known = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    df = df.select(*by, *[value.alias(c) for c, value in known.items()])
    largest = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if largest * len(columns) <= exact_rows:
        return _small(df, columns, probabilities, by)
    # Packed keys compare field by field, so a null key is a group of its own in every join.
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    found = _searched(df.select(key.alias("_by"), *columns), columns, probabilities, exact_rows)
    return found.select(*(["_by.*"] if by else []), "column_name", "probability", "value")


def _small(df, columns, probabilities, by) -> DataFrame:
    points = [float(p) for p in probabilities]
    found = df.groupBy(*by).agg(
        *[F.percentile(F.col(c).cast("double"), F.lit(points)).alias(c) for c in columns]
    )
    unknown = F.array_repeat(F.lit(None).cast("double"), len(points))
    per_column = [
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), unknown).alias("_values"))
        for c in columns
    ]
    named = found.select(*by, F.inline(F.array(*per_column)))
    pairs = F.arrays_zip(F.array(*map(F.lit, points)).alias("probability"), F.col("_values"))
    return named.select(*by, "column_name", F.explode(pairs).alias("_pair")).select(
        *by,
        "column_name",
        F.col("_pair.probability").alias("probability"),
        F.col("_pair._values").alias("value"),
    )


def _bracket(c: Column, low: Column, high: Column) -> Column:
    return (c >= low) & (c <= high)


def _sketched(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(_by, column_name, n, lo, hi, marks): extremes, and two sketched values that bracket each probability."""
    margin = 2.0 / ACCURACY
    marks = [v for p in probabilities for v in (max(float(p) - margin, 0.0), min(float(p) + margin, 1.0))]
    each = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.min(c).alias("lo"),
            F.max(c).alias("hi"),
            F.percentile_approx(c, marks, ACCURACY).alias("marks"),
        )
        for c in columns
    ]
    return df.groupBy("_by").agg(F.array(*each).alias("_all")).select("_by", F.inline("_all")).where("n > 0")


def _counted(df: DataFrame, brackets: DataFrame, columns: Sequence[str], size: int):
    """Values below and inside of each bracket as (_by, column_name, place, below, inside), and the values inside, staged."""
    wide = brackets.groupBy("_by").agg(
        *[F.first(F.when(F.col("column_name") == c, F.col("ends")), ignorenulls=True).alias(f"_ends{i}") for i, c in enumerate(columns)]
    )
    rows = df.join(lookup(wide), "_by")

    def end(i: int, j: int, name: str) -> Column:
        return F.col(f"_ends{i}")[j][name]

    counts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(j).alias("place"),
            F.count_if(F.col(c) < end(i, j, "lo")).alias("below"),
            F.count_if(_bracket(F.col(c), end(i, j, "lo"), end(i, j, "hi"))).alias("inside"),
        )
        for i, c in enumerate(columns)
        for j in range(size)
    ]
    counted = rows.groupBy("_by").agg(F.array(*counts).alias("_all")).select("_by", F.inline("_all"))

    def caught(i: int, c: str) -> Column:
        inside = reduce(or_, [_bracket(F.col(c), end(i, j, "lo"), end(i, j, "hi")) for j in range(size)])
        return F.when(inside, F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))

    met = F.array_compact(F.array(*[caught(i, c) for i, c in enumerate(columns)]))
    values = rows.select("_by", met.alias("_met")).where(F.size("_met") > 0).select("_by", F.inline("_met"))
    return stage(counted, "quantile-counts"), stage(values, "quantile-values")


def _searched(df, columns, probabilities, exact_rows) -> DataFrame:
    by, group = ["_by"], ["_by", "column_name"]
    points = [float(p) for p in probabilities]
    sketch = stage(_sketched(df, columns, points), "quantile-sketch")

    def ends(whole: bool) -> Column:
        """Brackets by place; the extremes close those at either end, and all of them if the sketch was not good enough."""
        pairs = []
        for j, p in enumerate(points):
            first, last = whole or p * ACCURACY <= 2, whole or (1 - p) * ACCURACY <= 2
            low = F.col("lo") if first else F.col("marks")[2 * j]
            high = F.col("hi") if last else F.col("marks")[2 * j + 1]
            pairs.append(F.struct(low.alias("lo"), high.alias("hi")))
        return F.array(*pairs)

    position = (F.col("n") - 1) * F.array(*map(F.lit, points))[F.col("place")]
    for whole in (False, True):
        brackets = sketch.select(*group, "n", ends(whole).alias("ends"))
        counted, values = _counted(df, brackets, columns, len(points))
        placed = brackets.select(*group, "n", F.posexplode("ends").alias("place", "_end")).withColumn("position", position)
        placed = placed.join(counted, [*group, "place"])
        wanted = stage(
            placed.select(
                *group, F.array(*map(F.lit, points))[F.col("place")].alias("probability"), "position",
                F.col("_end.lo").alias("lo"), F.col("_end.hi").alias("hi"), "below", "inside",
            ),
            "quantile-positions",
        )
        missed = (F.floor("position") < F.col("below")) | (F.ceil("position") >= F.col("below") + F.col("inside"))
        if wanted.where(missed).isEmpty():
            break
    ranks = wanted.select(
        *group, "lo", "hi", "inside", "below", F.explode(F.array(F.floor("position"), F.ceil("position"))).alias("rank")
    )
    # Brackets of near probabilities overlap and may hold the same rank: one of them is enough.
    ranks = stage(ranks.dropDuplicates([*group, "rank"]), "quantile-ranks")
    open_bins = (F.col("inside") > exact_rows) & (F.col("lo") < F.col("hi"))
    while not ranks.where(open_bins).isEmpty():
        narrowed = _narrow(values, ranks.where(open_bins), group)
        ranks = stage(ranks.where(~open_bins).unionByName(narrowed), "quantile-ranks")
    settled = ranks.where(F.col("lo") == F.col("hi")).select(*group, "rank", F.col("lo").alias("v"))
    short = _rank_inside(values, ranks.where(F.col("lo") < F.col("hi")), group)
    found = stage(settled.unionByName(short), "quantile-found")
    lower = found.select(*group, F.col("rank").alias("_lower"), F.col("v").alias("_v0"))
    upper = found.select(*group, F.col("rank").alias("_upper"), F.col("v").alias("_v1"))
    share = F.col("position") - F.col("_lower")
    value = F.when(share == 0, F.col("_v0")).when(F.col("_v0") == F.col("_v1"), F.col("_v0"))
    results = (
        wanted.withColumn("_lower", F.floor("position"))
        .withColumn("_upper", F.ceil("position"))
        .join(lower, [*group, "_lower"])
        .join(upper, [*group, "_upper"])
        .select(
            *group,
            "probability",
            value.otherwise(F.col("_v0") * (1 - share) + F.col("_v1") * share).alias("value"),
        )
    )
    # A column without a known value has null quantiles.
    asked = [F.array(*map(F.lit, columns)), F.array(*[F.lit(float(p)) for p in probabilities])]
    every = df.select(*by).distinct().select(*by, F.explode(asked[0]).alias("column_name")).select("*", F.explode(asked[1]).alias("probability"))
    return every.join(results, [*group, "probability"], "left").select(*group, "probability", "value")


def _narrow(values: DataFrame, ranks: DataFrame, group: list[str]) -> DataFrame:
    """Replace the bracket of each rank by the extent of its bin in that bracket."""
    brackets = ranks.select(*group, "lo", "hi").distinct()
    # Monotone in the value, so bins keep the order of the values exactly.
    # Infinite ends are binned as the largest numbers, ranges beyond a double by halves. The ends of a
    # bracket always fall into the first and the last bin, so every round narrows it.
    low, high, at = (F.greatest(F.least(F.col(c), F.lit(_LARGEST)), F.lit(-_LARGEST)) for c in ("lo", "hi", "value"))
    extent = high - low
    share = F.when(extent <= _LARGEST, (at - low) / extent).otherwise((at / 2 - low / 2) / (high / 2 - low / 2))
    share = F.when(F.col("value") == F.col("hi"), 1.0).when(F.col("value") == F.col("lo"), 0.0).otherwise(share)
    place = share * _BINS
    counted = (
        values.join(brackets, group)
        .where(F.col("value").between(F.col("lo"), F.col("hi")))
        .withColumn("_bin", F.least(F.floor(place), F.lit(_BINS - 1)))
        .groupBy(*group, "lo", "hi", "_bin")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("value").alias("_min"),
            F.max("value").alias("_max"),
        )
    )
    # At most _BINS rows per bracket.
    upto = Window.partitionBy(*group, "lo", "hi").orderBy("_bin")
    cumulated = counted.withColumn("_upto", F.sum("_n").over(upto))
    local = F.col("rank") - F.col("below")
    return (
        ranks.drop("inside")
        .join(cumulated, [*group, "lo", "hi"])
        .where((local < F.col("_upto")) & (local >= F.col("_upto") - F.col("_n")))
        .select(
            *group,
            F.col("_min").alias("lo"),
            F.col("_max").alias("hi"),
            F.col("_n").alias("inside"),
            (F.col("below") + F.col("_upto") - F.col("_n")).alias("below"),
            "rank",
        )
    )


def _rank_inside(values: DataFrame, ranks: DataFrame, group: list[str]) -> DataFrame:
    """Read the ranks off brackets that hold few rows."""
    brackets = ranks.select(*group, "lo", "hi").distinct()
    counted = (
        values.join(brackets, group)
        .where(F.col("value").between(F.col("lo"), F.col("hi")))
        .groupBy(*group, "lo", "hi", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = Window.partitionBy(*group, "lo", "hi").orderBy("value")
    cumulated = counted.withColumn("_upto", F.sum("_n").over(upto))
    local = F.col("rank") - F.col("below")
    return (
        ranks.join(cumulated, [*group, "lo", "hi"])
        .where((local < F.col("_upto")) & (local >= F.col("_upto") - F.col("_n")))
        .select(*group, "rank", F.col("value").alias("v"))
    )

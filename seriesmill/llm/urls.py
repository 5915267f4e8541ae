"""URL filters: host and path rules, and a tree of path templates per host, DataFrame functions only.

Rules like ``example.com/de/`` fit their host and its subdomains where the path starts with theirs; the longest wins.
All other urls are judged by templates: digits become ``#``, so most variable parts meet at once; level by level, a segment
of a host's path stays literal only if it is frequent below its parent, and the others become ``*``; labelled sibling branches
whose shares do not differ significantly are merged (``+``). A template is rejected if its smoothed share of labelled bad
urls passes a threshold. Shares are smoothed towards those of the parent, weighted by how much of the parent is labelled:
a template without labels is presumed to be like its labelled siblings only where those are most of the node.
In ``op2`` the labels are the rules' own verdicts.

Urls are aggregated to (host, digit-free path) before the tree is built, so a hot host costs one row for each shape of path.
A null url or one without ``://`` has an empty host and path; repeated rows get equal verdicts. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.packing import REST, packed
from seriesmill.session import lookup, stage

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels of the tree; the rest of a deeper path is the segment of the last level.
LEVELS = 6
#: A segment stays literal from this share of its parent's urls on.
LITERAL_SHARE = 0.02
#: Branches differ if their shares of bad labels are further apart than so many standard errors.
DIFFERENT = 1.96
PRIOR, STRENGTH, REJECT = 0.1, 4.0, 0.5


def host_of(url: Column) -> Column:
    # The pattern begins at the first "://": nothing before it may hold one.
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule (a later one of equal length does not replace an earlier one), else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _smoothed(bad: Column, good: Column, prior: Column) -> Column:
    return (bad + prior * STRENGTH) / (bad + good + STRENGTH)


def templates(shapes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """shapes (host, shape, rows, bad, good) with ``template`` and its smoothed ``purity`` (share of bad labels)."""
    segments = F.split(F.regexp_replace("shape", "^/", ""), "/")
    start = {"segments": segments, "prefix": F.lit(""), "prior": F.lit(PRIOR), "ended": F.lit(False)}
    tree = shapes.withColumns(start)
    sums = {"n": "rows", "b": "bad", "g": "good"}
    for level in range(levels):
        here = F.get("segments", F.lit(level))
        if level == levels - 1:
            # What is left of a deeper path counts as one segment.
            here = F.when(F.size("segments") > level, F.array_join(F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(1))), "/"))
        tree = tree.withColumn("seg", F.coalesce(F.concat(F.lit("/"), here), F.lit("")))
        branch = tree.groupBy("host", "prefix", "seg").agg(*[F.sum(c).alias(k) for k, c in sums.items()], F.max("prior").alias("prior"))
        branch = stage(branch, "url-branches")
        # Nodes by aggregation and join: a hot host is summed before the shuffle, and its branches may be split.
        node = branch.groupBy("host", "prefix").agg(*[F.sum(k).alias(f"node_{k}") for k in sums], F.max("prior").alias("above"))
        literal = (F.col("seg") == "") | (F.col("n") / F.col("node_n") >= LITERAL_SHARE)
        branch = branch.drop("prior").join(node, ["host", "prefix"]).withColumn("kind", F.when(literal, F.col("seg")).otherwise("/*"))
        kinds = branch.groupBy("host", "prefix", "kind").agg(F.sum("b").alias("kb"), F.sum("g").alias("kg"))
        # Labelled branches whose share of bad labels is like that of the whole node are one branch.
        labelled = F.col("kb") + F.col("kg")
        bearing = (F.col("kind") != "") & (labelled > 0)
        pools = kinds.where(bearing).groupBy("host", "prefix").agg((F.sum("kb") / F.sum(labelled)).alias("pooled"), F.count("*").alias("siblings"))
        error = F.sqrt(F.col("pooled") * (1 - F.col("pooled")) / labelled)
        alike = bearing & (F.col("siblings") > 1) & (F.abs(F.col("kb") / labelled - F.col("pooled")) <= DIFFERENT * error)
        kinds = kinds.join(pools, ["host", "prefix"], "left").select("host", "prefix", "kind", F.when(alike, "/+").otherwise(F.col("kind")).alias("step"))
        # What a branch may presume: the node's own share as far as its urls are labelled, the node's presumption for the rest.
        covered = (F.col("node_b") + F.col("node_g")) / F.col("node_n")
        presumed = F.col("above") + covered * (_smoothed(F.col("node_b"), F.col("node_g"), F.col("above")) - F.col("above"))
        steps = branch.join(kinds, ["host", "prefix", "kind"]).select("host", "prefix", "seg", "step", presumed.alias("presumed"))
        moved = tree.join(steps, ["host", "prefix", "seg"]).withColumns(
            {
                "prior": F.when(F.col("ended"), F.col("prior")).otherwise(F.col("presumed")),
                "prefix": F.concat("prefix", "step"),
                "ended": F.col("seg") == "",
            }
        )
        tree = stage(moved.drop("seg", "step", "presumed"), "url-tree")
    leaf = tree.groupBy("host", F.col("prefix").alias("template")).agg(
        F.sum("bad").alias("b"), F.sum("good").alias("g"), F.max("prior").alias("prior")
    )
    scored = leaf.select("host", "template", _smoothed(F.col("b"), F.col("g"), F.col("prior")).alias("purity"))
    return tree.select("host", "shape", F.col("prefix").alias("template")).join(scored, ["host", "template"])


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, label: Column | None = None) -> DataFrame:
    """The pages with host, path, rule, template, purity and verdict.

    ``label`` is an expression on ``url`` (block, allow or null) that the tree learns from; by default the verdicts of the rules.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = packed(pages, "url").withColumns({"host": host, "path": path}).withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    ruled = F.lit(None).cast("string")
    for rule, verdict in rules:
        ruled = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(ruled)
    seen = ruled if label is None else label
    rows = rows.withColumns({"_shape": F.regexp_replace("path", "[0-9]+", "#"), "_ruled": ruled, "_seen": seen})
    shapes = rows.groupBy("host", F.col("_shape").alias("shape")).agg(
        F.count("*").alias("rows"),
        F.sum(F.when(F.col("_seen") == "block", 1).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("_seen") == "allow", 1).otherwise(0)).alias("good"),
    )
    found = templates(stage(shapes, "url-shapes")).select(F.col("host").alias("_host"), F.col("shape").alias("_of"), "template", F.round("purity", 9).alias("purity"))
    out = rows.join(lookup(found), (rows.host == F.col("_host")) & (rows._shape == F.col("_of")), "left")
    verdict = F.coalesce("_ruled", F.when(F.col("purity") > REJECT, "block").otherwise("allow"))
    own = ("host", "path", "rule", "template", "purity", "verdict")
    shown = [F.col("url") if c == "url" else F.col(REST).getField(c).alias(c) for c in pages.columns if c not in own]
    return out.withColumn("verdict", verdict).select(*shown, *own)


def report(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    return judged(pages.select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict", "template", "purity")

import random

import pytest

from seriesmill.llm import mixing
from pyspark.sql import functions as F


def test_marginals_are_met(spark):
    rng = random.Random(1)
    rows = [
        (i, "w " * rng.randrange(1, 8), f"s{min(rng.randrange(9), 4)}", rng.choice(["en", "en", "fr"]), rng.choice([None, "t", "u"]))
        for i in range(3000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    cells = docs.withColumn("n", mixing.n_tokens(F.col("text"))).groupBy("source", "lang", "topic").agg(F.sum("n").alias("tokens"))
    targets = mixing.flattened_targets(cells, mixing.DIMENSIONS, 0.5)
    fitted = mixing.raked(cells, targets).cache()
    total = fitted.agg(F.sum("weight")).head()[0]
    for name, shares in targets.items():
        wanted = {r[0]: r[1] for r in shares.collect()}
        found = {r[0]: r[1] / total for r in fitted.groupBy(name).agg(F.sum("weight")).collect()}
        assert wanted.keys() == found.keys() and all(abs(wanted[k] - found[k]) < 1e-6 for k in wanted)
    out = mixing.mixed(docs, keep=0.5)
    assert out.count() == 3000
    tokens = out.agg(F.sum("n_tokens"), F.sum(F.expr("n_tokens * probability")), F.sum(F.expr("if(kept, n_tokens, 0)"))).head()
    assert abs(tokens[1] / tokens[0] - 0.5) < 0.01 and abs(tokens[2] / tokens[0] - 0.5) < 0.05


def test_odd_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, factor2 int"
    assert mixing.report(spark.createDataFrame([], kind)).count() == 0
    docs = spark.createDataFrame([(1, None, None, None, 0, 1), (2, "", "en", "a", 0, 1), (3, "a\tb  c", "en", "a", 6, 1), (None, "x", "en", "b", 1, 1), (3, "a\tb  c", "en", "a", 6, 1)], kind)
    found = mixing.report(docs).collect()
    assert sorted(r.n_tokens for r in found) == [0, 0, 1, 3, 3]
    assert len({r.kept for r in found if r.doc_id == 3}) == 1
    kept = mixing.sampled(docs)
    assert kept.columns == docs.columns and 1 in {r.doc_id for r in kept.collect()}


def raked_plainly(cells, targets, rounds):
    """Weights by nested loops: {cell: weight} from {cell: tokens} and one {category: share} per dimension."""
    total, weight = sum(cells.values()), {c: float(t) for c, t in cells.items() if t}
    for _ in range(rounds):
        for d, shares in enumerate(targets):
            held = {}
            for c, w in weight.items():
                held[c[d]] = held.get(c[d], 0.0) + w
            weight = {c: w * shares.get(c[d], 0.0) * total / held[c[d]] if held[c[d]] else 0.0 for c, w in weight.items()}
    return weight


def test_raking_equals_plain_version(spark):
    rng = random.Random(3)
    cells = {(s, l, t): rng.choice([0, 5, 40, 900]) for s in ("hot", "b", None) for l in ("en", None) for t in ("x", "y", "z") if rng.random() < 0.9}
    frame = spark.createDataFrame([(*c, n, 1) for c, n in cells.items()], "source string, lang string, topic string, tokens long, n_docs long")
    targets = mixing.flattened_targets(frame, mixing.DIMENSIONS, 0.5)
    wanted = raked_plainly(cells, [{r[0]: r[1] for r in targets[d].collect()} for d in mixing.DIMENSIONS], 400)
    fitted = mixing.raked(frame, targets)
    found = {(r.source, r.lang, r.topic): r.weight for r in fitted.collect()}
    total = sum(cells.values())
    assert found.keys() == wanted.keys() and all(abs(found[c] - wanted[c]) < 1e-6 * total for c in wanted)
    # The scale meets the wanted tokens unless all cells are full.
    for keep in (0.1, 0.5, 0.9, 1.0):
        rows = mixing.probabilities(fitted, keep).collect()
        assert abs(sum(r.tokens * r.probability for r in rows) - keep * total) < 1e-4 * total
        assert all(0 <= r.probability <= 1 for r in rows)


def test_contradicting_targets_are_said(spark):
    cells = spark.createDataFrame([("a", "en", "x", 10, 1), ("b", "fr", "x", 10, 1)], "source string, lang string, topic string, tokens long, n_docs long")
    wanted = {
        "source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, share double"),
        "lang": spark.createDataFrame([("en", 0.2), ("fr", 0.8)], "lang string, share double"),
    }
    with pytest.warns(UserWarning, match="contradict"):
        fitted = mixing.raked(cells, wanted)
    assert {r.lang: round(r.weight, 6) for r in fitted.collect()} == {"en": 4.0, "fr": 16.0}
    assert mixing.raked(cells.limit(0), wanted).count() == 0

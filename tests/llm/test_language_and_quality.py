"""Language identification and quality: held-out accuracy and odd rows."""

import zlib

import numpy as np
import pytest

from seriesmill.llm import langid, quality
from seriesmill.sources.tables import table

FOLDER = "/root/testdata/sf0.01"


def test_languages(spark):
    docs = table(spark, FOLDER, "documents")
    found = {r.doc_id: r for r in langid.report(docs).collect()}
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert found.keys() == known.keys()
    held = [k for k in known if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(found[k].held_out == (k in set(held)) for k in known)
    assert np.mean([found[k].lang_pred == known[k] for k in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_odd_texts(spark):
    rows = [(i, t, l, "x") for i, (t, l) in enumerate([(None, "en"), ("", "en"), ("123 !?", "en"), ("a", None), ("É" * 5, "fr"), ("the cat " * 30000, "en"), ("le chat", "fr")] * 9)]
    docs = spark.createDataFrame([*rows, (None, "the cat", "en", "x")], "doc_id long, text string, lang string, score string")
    found = langid.report(docs).collect()
    assert len(found) == len(rows) + 1
    assert {r.lang_pred for r in found if r.doc_id is not None and r.doc_id % 7 < 3} == {"und"}
    assert {r.lang_pred for r in found if r.doc_id is None or r.doc_id % 7 >= 3} <= {"en", "fr"}
    kept = langid.with_language(docs.drop("score"))
    assert kept.columns == ["doc_id", "text", "lang"] and kept.count() == 4 * 9 + 1
    assert langid.report(docs.limit(0)).count() == 0
    nothing = langid.report(docs.withColumn("lang", docs.lang.substr(1, 0)).filter("doc_id < 0"))
    assert nothing.count() == 0


def test_grades(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    found = {r.doc_id: r for r in quality.report(docs, labels).collect()}
    assert len(found) == docs.count()
    held = [r for r in quality.graded(labels).collect() if found[r.doc_id].held_out]
    expected, truth = np.array([found[r.doc_id].expected_grade for r in held]), np.array([r.grade for r in held])
    assert expected[truth == 2].mean() > expected[truth == 1].mean()
    good, bad = expected[truth == 2], expected[truth < 2]
    area = (good[:, None] > bad[None, :]).mean()
    print("area", area, "accuracy", np.mean([found[r.doc_id].grade_pred == r.grade for r in held]))
    assert area > 0.8


@pytest.mark.parametrize("rated", [[], [(1, 1, 0), (2, 0, 0), (3, 1, 1), (1, 0, 0)]])
def test_odd_rows(spark, rated):
    docs = spark.createDataFrame([(1, "good text"), (2, None), (3, ""), (None, "x " * 50000), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame(rated, "doc_id long, quality int, toxic int")
    found = quality.report(docs, labels).collect()
    assert len(found) == 5 and all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in found)
    assert quality.report(docs.limit(0), labels).count() == 0


def test_ordinal_fit_recovers_an_order():
    rng = np.random.default_rng(3)
    x = rng.normal(size=3000)
    grades = np.digitize(2 * x + rng.logistic(size=3000), [-1.0, 1.5])
    weights, thresholds = quality.fit_ordinal(np.arange(3000), np.full(3000, 7), x, grades)
    assert weights[7] > 1 and thresholds[0] < thresholds[1]
    assert np.corrcoef(quality.grade_chances(weights[7] * x, thresholds) @ np.arange(3), grades)[0, 1] > 0.6

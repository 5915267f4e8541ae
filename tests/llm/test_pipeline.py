"""Every stage on its own input against a brute-force version, and the whole run."""

import corpus_pipeline
from test_decontaminate import words
from test_ngram_join import brute as classes
from test_repeats import brute as passages

from seriesmill.llm import mixing
from seriesmill.sources.tables import table

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns, rows = docs.columns, docs.collect()
    items = [words(r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    windows = {tuple(x[i : i + 10]) for x in items if x for i in range(max(1, len(x) - 9))}
    frame = docs
    for place, (_, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, frame, FOLDER)
        if place < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        found = {r.doc_id: r for r in out.collect()}
        before = {r.doc_id: r for r in rows}
        if place == 0:
            assert found.keys() == {k for k, r in before.items() if any(c.isalpha() for c in r.text or "")}
        elif place == 1:
            assert found.keys() == {c for _, _, c in classes([(k, r.text) for k, r in before.items()])}
        elif place == 2:
            removed = {k: (size, gone) for k, size, gone, _, _ in passages([(k, r.text) for k, r in before.items()], 50)}
            assert found.keys() == {k for k, (size, gone) in removed.items() if gone < size or not size}
            assert all((found[k].text == before[k].text) == (not removed[k][1]) for k in found)
        elif place == 3:
            held = lambda x: any(tuple(x[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(x) - n + 1))
            assert found.keys() == {k for k, r in before.items() if not held(words(r.text))}
        else:
            drawn = mixing.mixed(frame.withColumn("topic", mixing.layout_topic(frame.text))).filter("kept").collect()
            assert found.keys() == {r.doc_id for r in drawn} and len(found) > 0.2 * len(before)
        rows = list(found.values())
        frame = spark.createDataFrame(rows, out.schema)


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == table(spark, FOLDER, "documents").columns and 0 < out.count() < 200

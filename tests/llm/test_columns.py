"""Extra columns of any name go through every stage with the input's own values."""

import pytest
from pyspark.sql import functions as F

from seriesmill.llm import decontaminate, langid, mixing, ngram_join, packing, repeats, urls

NAMES = {
    "langid": ["score", "lang_pred", "_letter", "held_out", "machine"],
    "mixing": ["kept", "n_tokens", "factor", "probability", "_source", "_lang", "topic2", "tokens"],
    "repeats": ["_id", "_rest", "_digest", "key", "digest", "copy", "starts", "places"],
    "ngram_join": ["kept_id", "mark", "n_shingles", "component_id", "class"],
    "decontaminate": ["_id", "_digest", "hits", "ids", "window", "digest"],
}
SHORT = "the cat sat on the mat with nothing else to do today "


def stages(spark):
    items = spark.createDataFrame([(1, "quite another benchmark item of ten words for the test")], "item_id long, text string")
    return {
        "langid": langid.with_language,
        "mixing": mixing.sampled,
        "repeats": repeats.without_repeats,
        "ngram_join": ngram_join.one_of_each,
        "decontaminate": lambda docs: decontaminate.clean_documents(docs, items),
    }


@pytest.mark.parametrize("stage", sorted(NAMES))
def test_columns_go_along(spark, stage):
    names = NAMES[stage] + [packing.REST, "a.b"]
    rows = [(i, SHORT + "x" * i if i % 3 else f"word{i} " * 30, "en", f"s{i % 2}", 9, *[f"{n} {i}" for n in names]) for i in range(40)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, kind)
    out = stages(spark)[stage](docs)
    assert out.columns == docs.columns and [t for c, t in out.dtypes] == [t for c, t in docs.dtypes]
    found = out.collect()
    assert found and all(r[n] == f"{n} {r['doc_id']}" for r in found for n in names)


def test_columns_of_pages(spark):
    names = ["_host", "_of", "_shape", "_ruled", "rows", packing.REST]
    pages = spark.createDataFrame([(1, "http://a.b/c", *names)], "page_id long, url string, " + ", ".join(f"`{n}` string" for n in names))
    (row,) = urls.judged(pages).collect()
    assert all(row[n] == n for n in names) and row.host == "a.b"


def test_tokens_of_a_text(spark):
    texts = {"\n a b \n": 2, "\t\n": 0, "\ta": 1, "": 0, None: 0, "a\tb  c": 3}
    frame = spark.createDataFrame([(t, n) for t, n in texts.items()], "text string, wanted long")
    assert all(r.wanted == r.n for r in frame.withColumn("n", mixing.n_tokens(F.col("text"))).collect())

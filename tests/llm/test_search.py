import math
import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from seriesmill.llm import search
from conftest import SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(doc, Counter(terms(text)), len(terms(text))) for doc, text in docs if doc is not None]
    held = [h for h in held if h[2]]
    n_docs, total = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc, counts, n in held:
            m = 50 + (50 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * counts[t]) // (1000 * counts[t] + 20 * m))
                for t in wanted if t in counts
            )
            if score > 0:
                scores.append((-score, doc))
        out += [(item, place, doc, -score) for place, (score, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def tables(seed, docs=300, frequent=0.5):
    rng = random.Random(seed)
    common, rare = ["the", "of", "À", "x9"], [f"w{i}" for i in range(150)]
    draw = lambda n: rng.choice([" ", "-", "\x00", "\n"]).join(rng.choice(common if rng.random() < frequent else rare).upper() if rng.random() < 0.2 else rng.choice(common if rng.random() < frequent else rare) for _ in range(n))
    rows = [(i, draw(rng.randrange(0, 40))) for i in range(docs)]
    rows += [(docs + i, rows[7][1]) for i in range(90)] + [(5, rows[5][1]), (None, "the w1"), (docs + 500, None)]
    items = [(i, draw(rng.randrange(0, 12))) for i in range(12)] + [(20, "the of À x9"), (21, "absent terms"), (22, None), (None, "the"), (3, "w3 w4")]
    items += [(23, rows[7][1])]
    return rows, items


@pytest.mark.parametrize("seed,k,most_terms,per_pass", [(1, 50, 10**6, 10**6), (2, 3, 10**6, 9), (3, 1, 0, 30), (4, 20, 0, 10**6)])
def test_equals_brute_force(spark, seed, k, most_terms, per_pass):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    docs, items = tables(seed, frequent=0.4 + 0.1 * seed)
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in search.ranked(left, right, k, most_terms, per_pass).collect())
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(docs, items, k)


def test_stops_creating_accumulators():
    """Documents with frequent terms only get no accumulator once a rare term decides; those that have one are exact."""
    rows = [{"item_id": "q", "term": t, "w": w, "df": n} for t, w, n in (("often", 10, 90), ("seldom", 3000, 4), ("absent", 9, 7))]
    query = search.asked(rows)
    times = [[3, 9]] * 4 + [[3]] * 86
    lists = [["often", "seldom"]] * 4 + [["often"]] * 86
    batch = pa.RecordBatch.from_pydict({"terms": lists, "times": times, "n": [12] * 90})
    block = search.block_of(batch, query, 90, 12 * 90)
    whole = search.scores_in(block, 90, query.terms[0], 90, 0)
    assert (whole > 0).all() and len(set(whole.tolist())) == 2
    few = search.scores_in(block, 90, query.terms[0], 3, 0)
    assert few[:4].tolist() == whole[:4].tolist() and not few[4:].any()
    assert not search.scores_in(block, 90, query.terms[0], 3, int(whole[0]) * 2).any()


def test_odd_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.ranked(docs, items).count() == 0 and search.ranked(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
    docs = spark.createDataFrame([(1, "a b " * 600_000, 1, "x", 2), (2, "a", 1, "x", 2), (3, "c", 1, "y", 3)], "doc_id long, text string, n long, term string, row long")
    items = spark.createDataFrame([(1, "A", 5)], "item_id long, text string, score long")
    got = sorted(tuple(r) for r in search.ranked(docs, items).collect())
    assert got == brute([(1, "a b " * 600_000), (2, "a"), (3, "c")], [(1, "a")], 50)
    assert search.ranked(docs, items.limit(0)).count() == 0


def test_equals_sql(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    answer = db.execute(search.SQL).fetchall()
    docs, items = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "benchmark"))
    assert sorted(answer) == sorted(tuple(r) for r in search.ranked(docs, items).collect())


def test_terms_of_few_documents_are_held_at_once():
    texts = [f"a b{i} a" for i in range(2 * search.HELD_DOCS + 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    made = list(search._held_terms(None)(iter([batch])))
    assert [len(b) for b in made] == [search.HELD_DOCS, search.HELD_DOCS, 1]
    rows = [r for b in made for r in b.to_pylist()]
    assert rows == [{"doc_id": i, "n": 3, "terms": ["a", f"b{i}"], "times": [2, 1]} for i in range(len(texts))]

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesmill.llm import spelling
from conftest import SMALL


def brute_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            check = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if check % 31 == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    others = {w: [v for v in counts if v != w and abs(len(v) - len(w)) < 2 and near(w, v)] for w in counts}
    best = {w: min(o, key=lambda v: (-counts[v], v)) for w, o in others.items() if o}
    form = {w: v for w, v in best.items() if counts[v] >= 10 * counts[w]}
    out = set()
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, counts[w], len(others[w]), counts[form[w]] if w in form else None))
    return out


def found(spark, rows, kind="doc_id long, text string", **sizes):
    return [tuple(r) for r in spelling.variants(spark.createDataFrame(rows, kind), **sizes).collect()]


@pytest.mark.parametrize("sizes", [{}, {"per_part": 7, "per_bucket": 20}])
def test_equals_brute_force(spark, sizes):
    rng = random.Random(5)
    stems = ["aaaaaaa", "aaaaaaaa", "abababa", "wördern", "straßen", "zzzzzzzz", "counting", "countings", "couting"]
    rows = []
    for doc in range(60):
        words = []
        for _ in range(40):
            w = rng.choice(stems) * (1 if rng.random() < 0.95 else 3)
            if rng.random() < 0.4:
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(["", "a", "b", "É", "ÿ"]) + w[at + rng.randrange(2) :]
            words.append(w if rng.random() < 0.8 else w.upper())
        rows.append((doc, rng.choice([" ", ", ", "1", "Ā", "\n"]).join(words)))
    rows += [(None, "countings countingz"), (3, None), (4, ""), (rows[0][0], rows[0][1])]
    got = found(spark, rows, **sizes)
    assert len(got) == len(set(got)) and set(got) == brute(brute_words(rows))


def test_documents_of_the_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = brute_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    counts = {w: n for w, n in counts.items() if n >= 5}
    words, linked = spelling.near_words(spark.createDataFrame(list(counts.items()), "word string, n long"), per_part=50, per_bucket=500)
    names = {r.id: r.word for r in words.collect()}
    assert [names[i] for i in sorted(names)] == sorted(names.values())
    got = {names[r.id]: (r.n_near, names[-r.best.minus_id]) for r in linked.collect()}
    for w in counts:
        o = [v for v in counts if v != w and abs(len(v) - len(w)) < 2 and near(w, v)]
        assert got.get(w) == ((len(o), min(o, key=lambda v: (-counts[v], v))) if o else None)


def test_chain_of_forms(spark):
    rows = [(-1, "startle " * 3000 + "startles " * 300 + "startlesx " * 30 + "startlesxy " * 3)]
    assert set(found(spark, rows)) == brute(brute_words(rows))


def test_odd_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, ""), (None, "?")]) == []
    rows = [("w", 1, "abcdefgh abcdefgh", 2), ("w", 1, "abcdefgh", 2)]
    got = found(spark, rows, "word string, doc_id long, text string, n long")
    assert set(got) == brute(brute_words([(r[1], r[2]) for r in rows]))


def test_long_text_and_long_word(spark):
    rows = [(1, "q" * 5000 + " " + "lengthy " * 300_000), (2, "q" * 5000 + "1" + "q" * 4999), (3, "q" * 4999)]
    assert set(found(spark, rows)) == brute(brute_words(rows))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=6), min_size=1, max_size=30), st.integers(1, 5))
def test_node_numbers_stand_for_prefixes(words, parts):
    """Ranges that are numbered apart agree on the prefixes that they share."""
    words = sorted(words)
    cuts = [words[i * len(words) // parts : (i + 1) * len(words) // parts] for i in range(parts)]
    seen, first, last, path = {}, 1, "", []
    for part in filter(None, cuts):
        deep = spelling.common(last, part[0])
        before = (last[:deep], path[:deep])
        own, last = first + sum(map(len, part)), part[-1]
        path = before[1][: spelling.common(before[0], last)]
        path = path + list(range(own, own + len(last) - len(path)))
        for word, nodes in zip(part, spelling.node_paths(part, first, [before, (last, path)])):
            for depth, node in enumerate(nodes):
                assert seen.setdefault(word[:depth], node) == node
        first = own + len(last)
    assert len(set(seen.values())) == len(seen)

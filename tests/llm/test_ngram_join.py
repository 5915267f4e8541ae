import random

import pytest

from seriesmill.llm import ngram_join


def brute(rows, size=5, percent=80):
    sets = {}
    for key, text in rows:
        found = (text or "").encode().lower().split()
        if len(found) >= size:
            sets[key] = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}
        else:
            sets[key] = {tuple(found)} if found else set()
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((k, len(sets[k]), root(k)) for k in sets)


def family(seed, base, copies, edits):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(base)]
    for _ in range(copies):
        out = list(words)
        for _ in range(edits):
            out[rng.randrange(base)] = f"x{rng.randrange(10**6)}"
        yield " ".join(out)


def test_against_brute_force(spark):
    texts = [None, "", " \t\n", "one", "One ", "a b c d", "a b c d e", "A B\tC D\nE", "é ü ß", "word " * 4000]
    shared = " ".join(f"s{i}" for i in range(12))
    for seed, (base, copies, edits) in enumerate([(60, 25, 1), (120, 30, 2), (200, 12, 4), (40, 9, 1), (300, 40, 5)]):
        texts += family(seed, base, copies, edits)
    rng = random.Random(9)
    texts += [shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 60))) for _ in range(60)]
    texts += texts[:40]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame([(k, t, "noise") for k, t in rows], "doc_id long, text string, mark string").repartition(5)
    found = ngram_join.near_classes(frame)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect())) == brute(rows)
    kept = ngram_join.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a b c d e f")]])
def test_empty_tables(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.near_classes(frame).collect()
    assert [tuple(r) for r in found] == [(k, 0, k) for k, t in rows if k is not None]

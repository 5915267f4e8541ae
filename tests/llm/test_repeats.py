import hashlib
import random
import tracemalloc

import pyarrow as pa
import pytest

from seriesmill.llm import repeats


def brute(rows, span):
    first = {}
    raw = {k: (t or "").encode() for k, t in rows}
    for k in sorted(raw):
        for i in range(len(raw[k]) - span + 1):
            first.setdefault(raw[k][i : i + span], k)
    out = []
    for k, data in sorted(raw.items()):
        hit = [False] * len(data)
        for i in range(len(data) - span + 1):
            if first[data[i : i + span]] < k:
                hit[i : i + span] = [True] * span
        spans = sum(h and (i == 0 or not hit[i - 1]) for i, h in enumerate(hit))
        kept = bytes(b for b, h in zip(data, hit) if not h)
        out.append((k, len(data), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def table():
    rng = random.Random(5)

    def prose(n):
        return " ".join(rng.choice(["the", "of", "élan", "über", "stone", "water", "mill", "x"]) + str(rng.randrange(900)) for _ in range(n))

    passages = [prose(12) for _ in range(6)]
    texts = [None, "", "a" * 49, "a" * 49, "a" * 50, "a" * 50, "a" * 200, "ab" * 100, "é" * 60, "x" + "é" * 60, prose(3000)]
    for _ in range(60):
        parts = [prose(rng.randrange(1, 30)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts)), rng.choice(passages)[rng.randrange(30) :])
        texts.append(" ".join(parts))
    for text in texts[20:40]:
        words = text.split(" ")
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = prose(1)
        texts.append(" ".join(words))
    texts += texts[30:34]
    keys = rng.sample(range(1000), len(texts))
    return list(zip(keys, texts))


def test_against_brute_force(spark):
    rows = table()
    frame = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, places int").repartition(4)
    assert sorted(map(tuple, repeats.report(frame).collect())) == brute(rows, 50)


def test_texts_that_stay(spark):
    rows = table()
    frame = spark.createDataFrame([(k, t, len(t or "")) for k, t in rows], "doc_id long, text string, n_chars long")
    kept = {r.doc_id: r for r in repeats.without_repeats(frame).collect()}
    for (key, size, removed, _, _), (_, text) in zip(brute(rows, 50), sorted(rows, key=lambda r: r[0])):
        assert (key in kept) == (removed < size or size == 0)
        if key in kept and not removed:
            assert kept[key].text == text
        elif key in kept:
            assert kept[key].n_chars == len(kept[key].text) and "�" not in kept[key].text


def test_empty_and_repeated_rows(spark):
    kind = "doc_id long, text string"
    assert repeats.report(spark.createDataFrame([], kind)).count() == 0
    text = "word " * 30
    twice = spark.createDataFrame([(3, text), (3, text), (None, text), (9, text)], kind)
    found = [tuple(r)[:4] for r in repeats.report(twice).orderBy("doc_id").collect()]
    assert found == [(3, 150, 0, 0), (3, 150, 0, 0), (9, 150, 150, 1)]


@pytest.mark.parametrize("layout", [1, 2, 4])
def test_rows_of_one_id_with_different_texts(spark, layout):
    """Each is cut on its own, they never match each other, and no layout changes that."""
    rng = random.Random(9)
    prose = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    x, y = prose(150), prose(150)
    rows = [(1, x), (2, x + " tail"), (2, y), (2, y + x), (3, y), (2, x + " tail"), (4, y + " more " + x), (4, prose(5) + y)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(layout)
    got = sorted((r.doc_id, r.text) for r in repeats.without_repeats(frame).collect())
    size = len(y)
    assert got[0] == (1, x) and [r for r in got if r[0] == 2] == sorted([(2, " tail"), (2, " tail"), (2, y), (2, y)])
    assert not [r for r in got if r[0] == 3] and (4, " more ") in got and len([r for r in got if r[0] == 4]) == 2
    report = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in repeats.report(frame).collect())
    assert (2, size, 0) in report and report.count((2, len(x) + 5, len(x))) == 2 and (2, size + len(x), len(x)) in report


def test_memory_of_a_slice():
    """Hashing a slice takes at most a hundred times its bytes."""
    rng = random.Random(2)
    column = pa.array(["".join(rng.choices("abcdefgh ", k=repeats.SLICE_BYTES // 8)) for _ in range(24)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(24)), column], ["doc_id", "text"])
    list(repeats._named(50, 8)(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    list(repeats._named(50, 8)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * repeats.SLICE_BYTES

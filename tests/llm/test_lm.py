import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesmill.llm import batches as B
from seriesmill.llm import lm, trie


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**12), max_size=200), st.lists(st.integers(0, 10**12), max_size=20))
def test_packed_values_are_read_and_found(values, others):
    values = np.unique(np.array(values, np.uint64))
    level = trie.encode(values, 10**12 + 1)
    assert (trie.access(level, np.arange(len(values))) == values).all()
    known = {int(v): i for i, v in enumerate(values)}
    asked = np.concatenate((values, np.array(others, np.uint64)))
    assert trie.find(level, asked).tolist() == [known.get(int(v), -1) for v in asked]
    assert (trie.find(level, values, 1, len(values) - 1) == [i if 1 <= i < len(values) - 1 else -1 for i in range(len(values))]).all()


@pytest.mark.parametrize("universe", [40, 5000, 1 << 20])
def test_pointers_may_repeat(universe):
    values = np.sort(np.random.default_rng(3).integers(0, universe, 3000)).astype(np.uint64)
    assert (trie.access(trie.encode(values, universe), np.arange(3000)) == values).all()


def test_quantised_shares_are_close_and_not_above():
    values = 10.0 ** np.random.default_rng(1).uniform(-15, 0, 5000)
    codes = trie.quantise(values)
    assert codes.dtype == np.uint16 and (trie.restore(codes) <= values * (1 + 1e-12)).all() and (trie.restore(codes) > 0.999 * values).all()


def rows():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(40)] + ["The", "É", "x|y"]
    odds = 1 / np.arange(1, len(words) + 1)
    texts = [None, "", " \n", "The the THE", "é É"]
    texts += [" ".join(rng.choice(words, rng.integers(1, 40), p=odds / odds.sum())) for _ in range(150)]
    texts += ["new words here", "w0 " * 3000]
    return list(enumerate(texts))


def held(key):
    return zlib.crc32(str(key).encode()) % 7 == 2


def split(text):
    return (text or "").encode().lower().split() + ["end"]


def plain_model(texts):
    """A function that scores a text under the model of order three, by dictionaries and without rounding."""
    triples, ones = Counter(), Counter()
    for x in texts:
        ones.update(x)
        triples.update(zip([0, 0, *x], [0, *x], x))
    pairs = Counter()
    for _, v, w in triples:
        pairs[v, w] += 1
    total = sum(ones.values()) + len(ones) + 1

    def order(grams):
        sums, left, times = Counter(), Counter(), Counter(grams.values())
        share = times[1] / max(1, times[1] + 2 * times[2])
        cuts = [0] + [min(max(c - (c + 1) * share * times[c + 1] / max(1, times[c]), lm.DISCOUNTS[0]), c * lm.DISCOUNTS[1]) for c in (1, 2, 3)]
        for g, c in grams.items():
            sums[g[:-1]] += c
            left[g[:-1]] += cuts[min(c, 3)]
        return lambda g, below: (grams[g] - cuts[min(grams[g], 3)] + left[g[:-1]] * below) / sums[g[:-1]] if sums[g[:-1]] else below

    near, far = order(pairs), order(triples)
    one = lambda w: (ones[w] + 1) / total
    return lambda x: sum(math.log10(far(g, near(g[1:], one(g[2])))) for g in zip([0, 0, *x], [0, *x], x))


@pytest.mark.parametrize("frequent", [8, lm.FREQUENT])
def test_counts_base_and_score(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    data = rows()
    tokens = {k: split(t) for k, t in data}
    counts = Counter(w for k, x in tokens.items() if not held(k) for w in x)
    n, v = sum(counts.values()), len(counts)
    frame = spark.createDataFrame([(k, t, 1.0) for k, t in data], "doc_id long, text string, base double").repartition(3)
    found = {r.doc_id: r for r in lm.scored(frame).collect()}
    assert found.keys() == tokens.keys()
    score = plain_model([x for k, x in tokens.items() if not held(k)])
    for k, x in tokens.items():
        r = found[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(k), len(x), sum(counts[w] > 0 for w in x), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in x), abs_tol=1e-9)
        assert abs(r.score - score(x)) < 0.02 * len(x)
    total = [sum(getattr(found[k], c) for k in tokens if held(k)) for c in ("score", "base_score")]
    assert all(r.score < 0 for r in found.values())
    assert total[0] > total[1] - 0.02 * abs(total[1])


def test_documents_score_as_the_plain_model(spark):
    """All documents of the smallest table, in one shard."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: split(r.text) for r in docs.collect()}
    score = plain_model([x for k, x in texts.items() if not held(k)])
    found = lm.scored(docs).collect()
    assert len(found) == len(texts)
    assert max(abs(r.score - score(texts[r.doc_id])) / r.n_tokens for r in found) < 0.02


def test_shards_and_parts_of_frequent_words(spark, monkeypatch):
    """What follows a frequent word is dealt out; counts stay exact and scores stay near those of one shard."""
    frame = spark.createDataFrame(rows(), "doc_id long, text string")
    whole = {r.doc_id: r for r in lm.scored(frame).collect()}
    monkeypatch.setattr(lm, "PAIRS_PER_SHARD", 200)
    monkeypatch.setattr(lm, "PART", 300)
    dealt = {r.doc_id: r for r in lm.scored(frame.repartition(4)).collect()}
    assert whole.keys() == dealt.keys()
    for k, r in whole.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (dealt[k].n_tokens, dealt[k].n_known, dealt[k].train_tokens)
        assert math.isclose(r.base_score, dealt[k].base_score, abs_tol=1e-9)
    one, many = (sum(r.score for r in found.values()) for found in (whole, dealt))
    assert abs(one - many) < 0.15 * abs(one)


@pytest.mark.parametrize("part", [30, 300])
def test_scores_do_not_depend_on_shards_and_parts(spark, monkeypatch, part):
    """Counts of contexts that are dealt out, and discounts, are those of all texts, in one shard or many."""
    line = " a line that all have w0 w1"
    data = [(k, (t or "") + line * (k % 3)) for k, t in rows()]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    whole = {r.doc_id: r.score for r in lm.scored(frame).collect()}
    monkeypatch.setattr(lm, "PAIRS_PER_SHARD", 100)
    monkeypatch.setattr(lm, "SHARDS_PER_MERGE", 10)
    monkeypatch.setattr(lm, "PART", part)
    monkeypatch.setattr(lm, "SLICE_BYTES", 4000)
    dealt = {r.doc_id: r.score for r in lm.scored(frame.repartition(4)).collect()}
    assert dealt == pytest.approx(whole, rel=1e-5)
    texts = {k: split(t) for k, t in data}
    score = plain_model([x for k, x in texts.items() if not held(k)])
    assert all(abs(dealt[k] - score(x)) < 0.002 * len(x) for k, x in texts.items())


def test_frequent_pairs_are_found(spark, monkeypatch):
    """All pairs above the limit, and none below half of it."""
    monkeypatch.setattr(lm, "PART", 100)
    monkeypatch.setattr(lm, "SLICE_BYTES", 2000)
    texts = [["start", "start", *split(t)] for _, t in rows()]
    counts = Counter(w for x in texts for w in x[2:])
    pairs = Counter(p for x in texts for p in zip(x, x[1:-1]))
    names = {w: int(lm.tokens(next(B.chunks(pa.array([w]))))[0][0]) for w in counts if w != "end"} | {"end": int(lm.END)}
    model = lm.Frequent(np.array([names[w] for w in counts], np.uint64), np.array([*counts.values()]), sum(counts.values()), len(counts))
    code = {w: int(model.code(np.array([h], np.uint64))[0]) for w, h in names.items()} | {"start": 0}
    found, times = lm.frequent_pairs(spark.createDataFrame(rows(), "doc_id long, text string").repartition(3), model)
    true = {code[u] << 20 | code[v]: c for (u, v), c in pairs.items()}
    assert {p for p, c in true.items() if c > 100} <= set(found.tolist()) <= {p for p, c in true.items() if c > 50}
    assert len(found) > 3 and all(c - 50 <= t <= c for t, c in ((t, true[p]) for p, t in zip(found.tolist(), times.tolist())))


def test_empty(spark):
    assert lm.scored(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    alone = lm.scored(spark.createDataFrame([(1, None), (None, "x")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.n_tokens) for r in alone] == [(1, 1)]


def test_probabilities_of_every_context_sum_to_at_most_one():
    rng = np.random.default_rng(2)
    draws = np.minimum(rng.zipf(1.3, 6000) - 1, 59).astype(np.uint64) + np.uint64(7)
    first, second, word = draws[1:-1], draws[:-2], draws[2:]
    ones = np.bincount(draws.astype(np.int64), minlength=67)[7:]
    p1 = (ones + 1) / (ones.sum() + 61)
    kinds = np.arange(7, 68, dtype=np.uint64)  # one of them unknown, also as a context
    grid = np.stack(np.meshgrid(kinds, kinds, kinds[:-1], indexing="ij")).reshape(3, -1)
    train = np.concatenate((np.ones(len(word), bool), np.zeros(grid.shape[1], bool)))
    q, b = lm.shares(*(np.concatenate(x) for x in zip((first, second, word), grid, strict=True)), train)
    q, b = q[len(word) :], b[len(word) :]
    sums = (q + b * p1[grid[2].astype(np.int64) - 7]).reshape(-1, 60).sum(1)
    assert sums.max() <= 1 + 1e-9 and sums.min() > 0.9


def test_held_out_texts_of_a_chain_beat_the_base(spark):
    rng = np.random.default_rng(7)
    follows = rng.permutation(60)

    def chain():
        at, words = rng.integers(60), []
        for _ in range(60):
            words.append(f"w{at}")
            at = follows[at] if rng.random() < 0.8 else rng.integers(60)
        return " ".join(words)

    frame = spark.createDataFrame([(i, chain()) for i in range(300)], "doc_id long, text string")
    found = [r for r in lm.scored(frame).collect() if r.held_out]
    assert len(found) > 20 and all(r.score > 0.8 * r.base_score for r in found)


def test_long_values_of_the_shuffle_are_packed_and_short_ones_kept():
    rng = np.random.default_rng(8)
    for rows in (0, 1, 30, 5000):
        columns = [rng.geometric(0.001, rows).astype(np.uint64), rng.integers(0, 256, rows).astype(np.uint8)]
        blob = lm._packed(lm._planes(columns))
        assert lm._size(blob) == 9 * rows and len(blob) <= (4 + 9 * rows if rows < 100 else 3.2 * rows)
        assert all((a == b).all() for a, b in zip(lm._columns([blob, blob], (np.uint64, np.uint8)), [np.tile(c, 2) for c in columns]))

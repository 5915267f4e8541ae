import numpy as np
import pytest

from seriesmill.llm import vectors


def brute(rows):
    good = {}
    for key, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            v = np.array(vector, np.float64)
            v = v / np.abs(v).max()
            good[key] = (label, v / np.linalg.norm(v))
    parent, links = {r[0]: r[0] for r in rows}, {r[0]: 0 for r in rows}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(good)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= 0.93:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((k, links[k], root(k), root(k) == k) for k in parent)


@pytest.mark.parametrize("block,per_cell", [(1024, 2048), (16, 20)])
def test_against_brute_force(spark, monkeypatch, block, per_cell):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "PER_CELL", per_cell)
    rng = np.random.default_rng(5)
    rows = []
    for group in range(40):
        centre = rng.normal(size=8)
        for _ in range(rng.integers(1, 14)):
            rows.append((centre + rng.normal(size=8) * rng.choice([0.02, 0.2, 0.35])).astype(np.float32).tolist())
    rows += [rows[3]] * 5 + [[0.0] * 8, None, [None] + [1.0] * 7, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1e-30] * 8, [1e30] * 8, [1.0] * 8, [1.0] * 3, []]
    data = [(1000 - i, v, None if i % 50 == 7 else int(i % 3 == 0)) for i, v in enumerate(rows)]
    frame = spark.createDataFrame([(*d, "n") for d in data], "vec_id long, embedding array<float>, label int, node string").repartition(4)
    assert sorted(map(tuple, vectors.linked(frame).collect())) == brute(data)


def test_empty(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert vectors.linked(spark.createDataFrame([], kind)).count() == 0
    alone = vectors.linked(spark.createDataFrame([(4, None, 1)], kind)).collect()
    assert [tuple(r) for r in alone] == [(4, 0, 4, True)]

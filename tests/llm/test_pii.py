import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesmill.llm import pii
from conftest import SMALL

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute_base(text):
    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, *m.span()) for k, p in PLAIN.items() for m in p.finditer(text or "") if valid(k, m.group())]


PIECES = ["a", "Zé", "7", "0", "255", "256", "4111111111111111", "4111 1111-1111 1111", ".", "@", "+", "-", " ", "(", ")", "\n", "x@y.com", "1.2.3.4", "+1 (487) 555-7209", "%"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_equals_plain_patterns(text):
    assert pii.base_spans(text) == brute_base(text)


def test_base_of_documents(spark):
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect():
        assert pii.base_spans(row.text or "") == brute_base(row.text)


def random_segments(rng, size=6):
    out = set()
    for _ in range(rng.randrange(1, 7)):
        a = rng.randrange(size)
        out.add((rng.choice(pii.KINDS), a, rng.randrange(a + 1, size + 1)))
    return [pii.Segment(k, a, b, (f"{k}{a}", f"len {b - a}")) for k, a, b in sorted(out, key=lambda s: (s[1], s[2], s[0]))]


def segmentations(segments):
    for n in range(len(segments) + 1):
        for chosen in itertools.combinations(range(len(segments)), n):
            ordered = sorted(chosen, key=lambda k: segments[k].start)
            if all(segments[a].end <= segments[b].start for a, b in zip(ordered, ordered[1:])):
                yield ordered


def total(segments, chosen, weights):
    value = sum(weights.get(n, 0.0) for k in chosen for n in segments[k].features)
    pairs = [(segments[a], segments[b]) for a, b in zip(chosen, chosen[1:])]
    return value + sum(weights.get(f"next to {a.kind} {b.kind}", 0.0) for a, b in pairs if a.end == b.start)


@pytest.mark.parametrize("seed", range(30))
def test_dynamic_programme_equals_enumeration(seed):
    rng = random.Random(seed)
    segments = random_segments(rng)
    names = sorted({n for s in segments for n in s.features} | {f"next to {y} {z}" for y in pii.KINDS for z in pii.KINDS})
    weights = {n: rng.gauss(0, 1) for n in names}
    every = list(segmentations(segments))
    best = max(every, key=lambda c: total(segments, c, weights))
    assert pii.best_segments(segments, weights) == [segments[k] for k in best]
    number = {n: i for i, n in enumerate(names)}
    values = np.array([weights[n] for n in names])
    truth = rng.choice(every)
    region = pii.Region(segments, [np.array([number[n] for n in s.features]) for s in segments], truth)
    found, gradient = pii.log_likelihood(region, values, number)
    expected = total(segments, truth, weights) - np.logaddexp.reduce([total(segments, c, weights) for c in every])
    assert found == pytest.approx(expected)
    for i in rng.sample(range(len(names)), 6):
        moved = values.copy()
        moved[i] += 1e-5
        assert gradient[i] == pytest.approx((pii.log_likelihood(region, moved, number)[0] - found) / 1e-5, abs=1e-3)


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 2 = 0")
    return pii.fitted(docs)


def test_held_out_respellings(spark, learned):
    """Regions of documents that were not fitted on: respelt data are found, other numbers are left alone."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 2 = 1").select("text").collect()
    there, hit, false = 0, 0, 0
    for (text,) in rows:
        base = pii.without_overlap(pii.base_spans(text or ""))
        for a, b in pii.regions(text or ""):
            inside = [(k, x - a, y - a) for k, x, y in base if a <= x and y <= b]
            if pii.fitting_region(text[a:b], inside) is None:
                continue
            for copy, spans in pii.copies(text[a:b], inside):
                got = {s[:3] for s in pii.best_segments(pii.candidates(copy), learned)}
                there, hit, false = there + len(spans), hit + len(got & set(spans)), false + len(got - set(spans))
    assert there > 30 and hit >= 0.9 * there and false <= 0.1 * there


def test_rows(spark, learned):
    texts = [None, "", "no data", "joe@x.com or joe at mail dot x dot com", "call 487-555-7209 now", "1" * 3_000_000, "+1 (487) 555-7209 " * 3000, "a@" * 200_000, "9." * 100_000]
    rows = [(i, "x", t, 1) for i, t in enumerate(texts)] + [(None, "y", texts[3], 2), (3, "z", texts[3], 3)]
    docs = spark.createDataFrame(rows, "doc_id int, spans string, text string, n_email int")
    found = pii.personal_data(docs, learned)
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    got = found.collect()
    assert len(got) == len(rows)
    for row in got:
        base = brute_base(texts[3 if row.doc_id is None else row.doc_id]) if row.doc_id != 5 else []
        named = [f"{k}:{a}:{b}" for k, a, b in base]
        assert row.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(k == b[0] for b in base) for k in pii.KINDS]
        spans = row.spans.split(",") if row.spans else []
        assert set(named) <= set(spans) and len(spans) == len(named) + row.n_added
    by_id = {r.doc_id: r for r in got}
    assert "email:13:38" in by_id[3].spans and "phone:5:17" in by_id[4].spans
    assert pii.personal_data(docs.limit(0)).count() == 0
    assert [r.n_added for r in pii.personal_data(docs.filter("doc_id < 5"), {}).collect()] == [0] * 6

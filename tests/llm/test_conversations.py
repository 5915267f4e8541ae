import random

from seriesmill.llm import conversations as C


def brute(rows):
    talks = {}
    key = lambda r: tuple((x is not None, x if x is not None else "") for x in r[1:])
    for row in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], (r[1] is not None, r[1] or 0), key(r)[1:])):
        talks.setdefault(row[0], []).append(row[2:])
    kept = {}
    for name, turns in talks.items():
        longer = any(o[: len(turns)] == turns and (len(o) > len(turns) or (len(o) == len(turns) and n < name)) for n, o in talks.items() if n != name)
        if not longer:
            kept[name] = turns
    return talks, kept


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 3)
    rng = random.Random(2)
    rows = []
    for talk in range(60):
        base = random.Random(talk % 9)
        turns = [("user" if i % 2 == 0 else base.choice(["assistant", None]), base.choice(["hi", "", None, "ok", "x" * 50])) for i in range(12)]
        rows += [(talk, i, *t) for i, t in enumerate(turns[: rng.randrange(1, 13)])]
    rows += [(100, None, "user", "hi"), (100, None, "user", "hi"), (None, 0, "user", "hi"), (101, 0, "user", "hi"), (101, 0, "user", "hi")]
    frame = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, place string").repartition(4)
    talks, kept = brute(rows)
    verdicts = {r.conv_id: r for r in C.judged(frame)[1].collect()}
    assert {k: (len(t), k in kept) for k, t in talks.items()} == {k: (r.n_turns, r.kept) for k, r in verdicts.items()}
    monkeypatch.setattr(C, "TURNS", 5)
    texts = {}
    for r in sorted(C.rendered(frame).collect(), key=lambda r: (r.conv_id, r.part)):
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.text
    assert texts == {k: "".join(f"{C.BEGIN}{a or ''}\n{b or ''}{C.END}\n" for a, b in t) for k, t in kept.items()}
    assert C.rendered(frame.limit(0)).count() == 0

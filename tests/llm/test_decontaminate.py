import hashlib
import random
import re

from seriesmill.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    windows = {}
    for key, text in items:
        found = words(text)
        for i in range(max(1, len(found) - width + 1)) if found else ():
            windows.setdefault(tuple(found[i : i + width]), set()).add(key)
    out = []
    for key, text in docs:
        found, hit, held = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                if (names := windows.get(tuple(found[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    held |= names
        digest = hashlib.sha256(",".join(sorted(map(str, held))).encode()).hexdigest()
        out.append((key, len(found), len(hit), len(held), digest, bool(hit)))
    return sorted(out, key=repr)


def tables():
    rng = random.Random(3)
    draw = lambda n: " ".join(rng.choice(["The", "of", "Élan", "ÜBER", "K9", "mill", "a"]) + rng.choice([" ", ", ", "\n", "-"]) + str(rng.randrange(40)) for _ in range(n))
    items = [(1, draw(12)), (2, draw(5)), (3, "three short words"), (4, ""), (5, None), (10, draw(30)), (11, "the " * 14), (6, "... !!")]
    items += [(20, items[0][1]), (1, items[0][1])]
    docs = [None, "", "?", "the", "Three SHORT, words", "x Three short words", "three short wordsy", "the " * 40, "THE " * 9, "über 3 short words"]
    for _ in range(60):
        text = draw(rng.randrange(1, 25))
        if rng.random() < 0.6:
            text += " / " + rng.choice(items[:3] + items[5:7])[1].upper().replace("É", "é")[rng.randrange(8) :] + " " + draw(2)
        docs.append(text)
    docs.append("long " * 30000 + items[5][1])
    return list(enumerate(docs)) + [(70, docs[20]), (20, docs[20])], items


def test_against_brute_force(spark):
    docs, items = tables()
    frame = spark.createDataFrame([(k, t, "w") for k, t in docs], "doc_id long, text string, window string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.report(frame, bench)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    wanted = brute(docs, items)
    assert sorted(map(tuple, found.collect()), key=repr) == wanted
    clean = decontaminate.clean_documents(frame, bench)
    assert clean.columns == frame.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(w[0] for w in wanted if not w[5])


def test_shuffled_windows_and_empty_tables(spark, monkeypatch):
    docs, items = tables()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "lookup", lambda df: df)
    assert sorted(map(tuple, decontaminate.report(frame, bench).collect()), key=repr) == brute(docs, items)
    assert decontaminate.report(frame.limit(0), bench).count() == 0
    assert decontaminate.report(frame, bench.limit(0)).filter("contaminated").count() == 0


def test_texts_are_split_once_for_the_number_of_words(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    plan = decontaminate.report(docs, bench)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_every_ascii_character_but_letters_and_digits_stands_between_words(spark):
    docs = [(c, f"a{chr(c)}b") for c in (*range(256), 0x130, 0x212A, 0x3000, 0xFFFD, 0x1F600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, "b"), (2, "x")]
    found = decontaminate.report(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items)

"""Language identification in two steps: first the family, then one-versus-one linear support vector machines within it.

Features are shares of hashed byte pairs and triples of the text (A-Z lower-cased). A linear machine for each family tells it from the others;
within a family each pair of languages has a machine, and the language with the highest mean probability over its pairs wins.

The machines are fitted on a bounded sample of labelled rows: about ``SAMPLE`` texts of each language, chosen by a hash of doc_id,
whole, and fitted one machine a task. Prediction reads every whole text in one pass.

A null text or one without a letter is ``und`` with score 0, and so is every text if nothing is labelled. With one language or one family
only, the step that has nothing to tell apart is certain. Codes that no family lists form a family of their own. Equal texts get equal
results; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.llm import batches as B
from seriesmill.llm.packing import packed, unpacked
from seriesmill.session import stage

#: Languages of a family, by their codes.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "rm", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "semitic": ("am", "ar", "he", "mt"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "malayic": ("id", "jv", "ms", "su"),
}
UNKNOWN = "und"
FEATURES = 1 << 14
#: Most texts (in expectation) of a language that machines are fitted on.
SAMPLE = 1000
SCALE = 30.0
EPOCHS = 8
HELD_OUT = "pmod(crc32(cast(coalesce(cast(doc_id AS string), '') AS binary)), 3) = 1"


def family_of(lang: str) -> str:
    base = lang.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in FAMILIES.items() if base in codes), f"only {base}")


def grams(texts: B.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every byte pair and triple that lies within a text."""
    data = B.LOWER[texts.data].astype(np.uint32)
    ends = np.repeat(texts.offsets[1:], np.diff(texts.offsets))
    rows = np.repeat(np.arange(texts.last - texts.first, dtype=np.int32), np.diff(texts.offsets))
    out_rows, out = [], []
    for size in (2, 3):
        if len(data) < size:
            continue
        key = np.zeros(len(data) - size + 1, np.uint32)
        for step in range(size):
            key = key * np.uint32(0x01000193) + data[step : len(data) - size + 1 + step] + np.uint32(1)
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x2C1B3C6D)
        key ^= key >> np.uint32(13)
        inside = np.arange(len(key)) + size <= ends[: len(key)]
        out_rows.append(rows[: len(key)][inside])
        out.append((key[inside] & np.uint32(FEATURES - 1)).astype(np.int32))
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(out_rows), np.concatenate(out)


def _sparse(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, and the features of the text with their shares."""
    for batch in source:
        for texts in B.chunks(batch.column("text")):
            rows, found = grams(texts)
            keys, counts = np.unique(rows.astype(np.int64) * FEATURES + found, return_counts=True)
            row, size = keys // FEATURES, texts.last - texts.first
            total = np.bincount(row, weights=counts, minlength=size)
            offsets = np.searchsorted(row, np.arange(size + 1))
            shares = SCALE * counts / np.maximum(total, 1)[row]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(texts.first, size), B.lists((keys % FEATURES).astype(np.int32), offsets), B.lists(shares.astype(np.float32), offsets)],
                ["lang", "places", "shares"],
            )


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray) -> np.ndarray:
    """Weights (the last one is the offset) of a linear support vector machine, by averaged subgradient steps; classes weigh the same."""
    weights, total = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    sides = [max(1, int((signs == s).sum())) for s in (-1, 1)]
    order, random, steps = np.arange(len(rows)), np.random.default_rng(0), 0
    for epoch in range(EPOCHS):
        random.shuffle(order)
        for i in order:
            places, shares = rows[i]
            sign = signs[i]
            steps += 1
            if sign * (weights[places] @ shares + weights[-1]) < 1:
                rate = sign * 0.5 / np.sqrt(1 + epoch) * min(sides) / sides[int(sign > 0)]
                weights[places] += rate * shares
                weights[-1] += rate
        total += weights
    return (total / EPOCHS).astype(np.float32)


def _fit(key, table):
    name = key[0].as_py()
    lists = [table.column(c).combine_chunks() for c in ("places", "shares")]
    offsets = lists[0].offsets.to_numpy()
    places, shares = lists[0].values.to_numpy(), lists[1].values.to_numpy()
    rows = [(places[a:b], shares[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    # The order of rows depends on the shuffle; sorting makes the fit repeatable.
    signs = table.column("sign").to_numpy().astype(np.float64)
    order = sorted(range(len(rows)), key=lambda i: (signs[i], rows[i][0].tobytes(), rows[i][1].tobytes()))
    weights = fit_machine([rows[i] for i in order], signs[order])
    return pa.table({"machine": [name], "weights": B.lists(weights, np.array([0, len(weights)]))})


class Machines:
    """Families, their languages, and the weights of all machines side by side."""

    def __init__(self, langs: list[str], weights: dict[str, np.ndarray]):
        self.families: dict[str, list[str]] = {}
        for lang in sorted(langs):
            self.families.setdefault(family_of(lang), []).append(lang)
        self.names = sorted(weights)
        self.weights = np.array([weights[n] for n in self.names], np.float32).T if weights else np.zeros((FEATURES + 1, 0), np.float32)

    def margins(self, texts: B.Texts) -> np.ndarray:
        rows, found = grams(texts)
        size = texts.last - texts.first
        total = np.maximum(np.bincount(rows, minlength=size), 1)
        out = np.empty((size, len(self.names)))
        for i in range(len(self.names)):
            out[:, i] = SCALE * np.bincount(rows, weights=self.weights[found, i], minlength=size) / total + self.weights[-1, i]
        return out

    def predict(self, texts: B.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(language, score) of every text of a chunk."""
        margins = 1 / (1 + np.exp(-2 * np.clip(self.margins(texts), -30, 30)))
        of = {name: margins[:, i] for i, name in enumerate(self.names)}
        size = texts.last - texts.first
        names = list(self.families)
        family = np.ones((size, 1))
        if len(names) > 1:
            family = np.stack([of[f"family {f}"] for f in names], axis=1) + 1e-9
            family /= family.sum(axis=1, keepdims=True)
        best = family.argmax(axis=1)
        langs, scores = np.empty(size, object), np.zeros(size)
        for i, name in enumerate(names):
            mine, codes = best == i, self.families[name]
            inner = np.ones((size, 1))
            if len(codes) > 1:
                inner = np.zeros((size, len(codes)))
                for a in range(len(codes)):
                    for b in range(a + 1, len(codes)):
                        inner[:, a] += of[f"pair {codes[a]} {codes[b]}"]
                        inner[:, b] += 1 - of[f"pair {codes[a]} {codes[b]}"]
                inner /= len(codes) - 1
            pick = inner.argmax(axis=1)
            langs[mine] = np.array(codes, object)[pick[mine]]
            scores[mine] = (family[np.arange(size), i] * inner[np.arange(size), pick])[mine]
        return langs, np.clip(scores, 0, 1)


def fit(docs: DataFrame, held_out: str = HELD_OUT, sample: int = SAMPLE) -> Machines:
    """Machines from the rows with a text and a lang that are not held out."""
    labelled = docs.filter(f"text IS NOT NULL AND lang IS NOT NULL AND NOT ({held_out})").select("doc_id", "text", "lang")
    counts = labelled.groupBy("lang").count()
    langs = [r["lang"] for r in counts.select("lang").collect()]  # languages are few
    chance = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    some = labelled.join(F.broadcast(counts), "lang").filter(chance * F.col("count") < sample).select("text", "lang")
    sparse = stage(some.mapInArrow(_sparse, "lang string, places array<int>, shares array<float>"), "language-sample")
    families: dict[str, list[str]] = {}
    for lang in sorted(langs):
        families.setdefault(family_of(lang), []).append(lang)
    tasks = []
    if len(families) > 1:
        tasks += [(f"family {f}", lang, 1 if lang in own else -1) for f, own in families.items() for lang in langs]
    for own in families.values():
        tasks += [(f"pair {a} {b}", lang, 1 if lang == a else -1) for i, a in enumerate(own) for b in own[i + 1 :] for lang in (a, b)]
    if not tasks:
        return Machines(langs, {})
    plan = docs.sparkSession.createDataFrame(tasks, "machine string, lang string, sign int")
    fitted = sparse.join(F.broadcast(plan), "lang").groupBy("machine").applyInArrow(_fit, "machine string, weights array<float>")
    return Machines(langs, {r["machine"]: np.array(r["weights"], np.float32) for r in fitted.collect()})


def identified(docs: DataFrame, machines: Machines) -> DataFrame:
    """The documents with lang_pred and score; only the text is looked at. The names _letter, lang_pred and score are taken."""
    model = docs.sparkSession.sparkContext.broadcast(machines)
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            kept = batch.select(columns)
            letter = batch.column("_letter").to_numpy(zero_copy_only=False).astype(bool)
            for texts in B.chunks(batch.column("text")):
                size = texts.last - texts.first
                known = letter[texts.first : texts.last] & bool(model.value.families)
                langs, scores = model.value.predict(texts) if model.value.families else (np.full(size, UNKNOWN, object), np.zeros(size))
                langs[~known], scores[~known] = UNKNOWN, 0.0
                rows = kept.slice(texts.first, size)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(langs, pa.string()), pa.array(scores)], [*columns, "lang_pred", "score"])

    return docs.withColumn("_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    found = identified(docs.select("doc_id", "text"), fit(docs)).select("doc_id", "lang_pred", "score")
    return found.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame) -> DataFrame:
    """The documents that have a language, with ``lang`` as predicted; those without any letter go."""
    found = identified(packed(docs, "text"), fit(docs)).filter(F.col("lang_pred") != UNKNOWN)
    return unpacked(found.withColumn("lang", F.col("lang_pred")), docs.columns, ("text", "lang"))

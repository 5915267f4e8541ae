"""Quality of texts by ordinal regression on graded ratings (cumulative links).

One weight for each hashed feature of a text and ordered thresholds give the probability of every grade: P(grade <= k) is the logistic of
threshold k less the weighted sum. Features are the words (A-Z lower-cased), the ends of words, and how long and how varied the text is. The
expected grade and the probability of the highest grade serve for selection.

Grades of the labels are 0 for toxic, 1 for poor and 2 for good. The model is fitted on a bounded sample of rated rows: about ``SAMPLE``,
chosen by a hash of doc_id, in one task. A document rated several times takes its lowest grade. Scoring reads every whole text once.

Nulls and empty texts have the features of an empty text. Without any rating, every grade is equally probable. Equal texts get equal
scores; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.llm import batches as B
from seriesmill.session import stage

FEATURES = 1 << 16
#: Rated rows (in expectation) that the model is fitted on.
SAMPLE = 8000
STEPS = 250
GRADES = 3
HELD_OUT = "pmod(crc32(cast(coalesce(cast(doc_id AS string), '') AS binary)), 5) = 0"


def features(texts: B.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value), each feature once a text."""
    found = B.words(texts)
    rows, counts = texts.last - texts.first, np.diff(found.offsets)
    row = np.repeat(np.arange(rows), counts)
    data = texts.data
    last = data[found.ends - 1].astype(np.uint64) if len(row) else np.zeros(0, np.uint64)
    before = data[np.maximum(found.ends - 2, 0)].astype(np.uint64) if len(row) else last
    plain = ((last | np.uint64(32)) >= 97) & ((last | np.uint64(32)) <= 122) | (last >= 128)
    ends = B.mix((before * np.uint64(256) + last) * B.GOLDEN) | np.uint64(1)
    word = (row.astype(np.uint64) << np.uint64(16)) | (found.hashes >> np.uint64(48))
    mark = (row.astype(np.uint64) << np.uint64(16)) | (ends >> np.uint64(48))
    distinct = np.unique(word)
    kinds = np.bincount((distinct >> np.uint64(16)).astype(np.int64), minlength=rows)
    marks, times = np.unique(mark[~plain], return_counts=True)
    mark_row = (marks >> np.uint64(16)).astype(np.int64)
    shape = np.stack([np.minimum(np.log2(counts + 1), 15) // 1, 20 + (10 * kinds // np.maximum(counts, 1)), 40 + (10 * np.bincount(row, weights=~plain, minlength=rows) // np.maximum(counts, 1))])
    shape = (B.mix((shape.astype(np.uint64) + np.uint64(1)) * B.GOLDEN) >> np.uint64(48)).astype(np.int64)
    every = np.arange(rows)
    out_row = np.concatenate(((distinct >> np.uint64(16)).astype(np.int64), mark_row, every, every, every))
    out = np.concatenate(((distinct & np.uint64(0xFFFF)).astype(np.int64), (marks & np.uint64(0xFFFF)).astype(np.int64), *shape))
    values = np.concatenate((1 / np.sqrt(1 + np.log1p(kinds))[(distinct >> np.uint64(16)).astype(np.int64)], 5 * times / np.maximum(counts, 1)[mark_row], np.ones(3 * rows)))
    return out_row, out, values


def _sparse(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        for texts in B.chunks(batch.column("text")):
            size = texts.last - texts.first
            row, place, value = features(texts)
            order = np.lexsort((place, row))
            offsets = np.searchsorted(row[order], np.arange(size + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(texts.first, size), batch.column("grade").slice(texts.first, size), B.lists(place[order].astype(np.int32), offsets), B.lists(value[order].astype(np.float32), offsets)],
                ["doc_id", "grade", "places", "shares"],
            )


def grade_chances(sums: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Probability of each grade (columns) at each weighted sum."""
    below = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - sums[:, None], -40, 40)))
    edges = np.concatenate((np.zeros((len(sums), 1)), below, np.ones((len(sums), 1))), axis=1)
    return np.maximum(np.diff(edges, axis=1), 1e-12)


def fit_ordinal(row: np.ndarray, place: np.ndarray, value: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of largest likelihood, with a small penalty; classes weigh alike (by root of frequency)."""
    held = np.maximum(np.bincount(grades, minlength=GRADES), 1)
    each = np.sqrt(len(grades) / held)[grades]
    each /= each.sum()
    weights = np.zeros(FEATURES)
    first, gaps = -1.0, np.zeros(GRADES - 2)
    square, mean = np.zeros(FEATURES + GRADES - 1), np.zeros(FEATURES + GRADES - 1)
    for step in range(1, STEPS + 1):
        thresholds = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        sums = np.bincount(row, weights=weights[place] * value, minlength=len(grades))
        below = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - sums[:, None], -40, 40)))
        slope = np.concatenate((np.zeros((len(grades), 1)), below * (1 - below), np.zeros((len(grades), 1))), axis=1)
        chance = grade_chances(sums, thresholds)[np.arange(len(grades)), grades]
        up, down = slope[np.arange(len(grades)), grades + 1], slope[np.arange(len(grades)), grades]
        by_sum = each * (up - down) / chance  # of the negative log likelihood
        by_threshold = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            by_threshold[k] = -(each * (np.where(grades == k, slope[:, k + 1], 0) - np.where(grades == k + 1, slope[:, k + 1], 0)) / chance).sum()
        gradient = np.concatenate((
            np.bincount(place, weights=by_sum[row] * value, minlength=FEATURES) + 1e-5 * weights,
            [by_threshold.sum()], np.exp(gaps) * np.cumsum(by_threshold[::-1])[::-1][1:],
        ))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient * gradient
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights -= move[:FEATURES]
        first -= move[FEATURES]
        gaps -= move[FEATURES + 1 :]
    return weights, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))


def _fit(key, table):
    table = table.sort_by("doc_id")
    lists = [table.column(c).combine_chunks() for c in ("places", "shares")]
    sizes = np.diff(lists[0].offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    weights, thresholds = fit_ordinal(row, lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy().astype(np.float64), table.column("grade").to_numpy())
    whole = np.concatenate((thresholds, weights))
    return pa.table({"model": B.lists(whole, np.array([0, len(whole)]))})


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of rated documents."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).filter("grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, labels: DataFrame, held_out: str = HELD_OUT, sample: int = SAMPLE) -> np.ndarray:
    """Thresholds, then weights; rows that are held out are not looked at."""
    rated = graded(labels).filter(f"NOT ({held_out})")
    total = rated.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    some = docs.select("doc_id", "text").join(F.broadcast(stage(rated.filter(draw * F.lit(total) < sample), "rated")), "doc_id")
    sparse = some.mapInArrow(_sparse, "doc_id long, grade int, places array<int>, shares array<float>")
    found = sparse.groupBy(F.lit(0).alias("one")).applyInArrow(_fit, "model array<double>").collect()
    even = -np.log(np.arange(GRADES - 1, 0, -1) / np.arange(1, GRADES))
    return np.array(found[0]["model"]) if found else np.concatenate((even, np.zeros(FEATURES)))


def scored(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """The documents with expected_grade, tail_probability (of the highest grade) and grade_pred (the likeliest grade)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType()), T.StructField("grade_pred", T.IntegerType())]
    )

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        thresholds, weights = shared.value[: GRADES - 1], shared.value[GRADES - 1 :]
        for batch in source:
            for texts in B.chunks(batch.column("text")):
                size = texts.last - texts.first
                row, place, value = features(texts)
                chances = grade_chances(np.bincount(row, weights=weights[place] * value, minlength=size), thresholds)
                rows = batch.slice(texts.first, size)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(chances @ np.arange(GRADES)), pa.array(chances[:, -1]), pa.array(chances.argmax(axis=1).astype(np.int32))],
                    [*columns, "expected_grade", "tail_probability", "grade_pred"],
                )

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, expected_grade, tail_probability, grade_pred) of every document."""
    found = scored(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")
    return found.withColumn("held_out", F.expr(HELD_OUT))

"""Ranked lexical search, term at a time with a limit on accumulators.

Documents are indexed in blocks, each in one task. For every item a block takes the item's terms rarest first (by documents of the
whole table). A term's postings add to the accumulators of documents and create new ones, until the bounds of the terms to come, the
block's largest contributions, cannot bring a document that has none above the kth partial score, or above the kth score that the
task has found so far; equality may still win a tie, so it does not stop. The accumulators there are, the survivors, go on
to be updated exactly. Each task keeps the k best of each item, and the k best of all tasks are ranked; scores are exact integers.

One pass over the texts keeps, for the vocabulary of the items, what each document holds, so frequent terms are lists in the
rows of their documents and no term or item is ever gathered in one place. The vocabulary filters the texts up to
``LOOKUP_ROWS`` terms; beyond that documents keep all their terms. Items are asked in blocks of about ``ASKED`` terms, each a pass over
the index.

A null text has no terms. A document is a row: repeated rows count and rank each; rows with a null ``doc_id`` are left out of
everything. Items with a null id or without terms have no results; rows that repeat an item_id are one item
with the terms of all. Equal scores rank by ascending ``doc_id``. Empty tables give no rows; extra columns are ignored. Texts
of any length are split in slices at term ends.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.session import LOOKUP_ROWS, stage

BEST = 50
#: Terms of items that are asked in one pass over the index.
ASKED = 200_000
SLICE = 1 << 20
#: Documents whose terms are held at once; each has a table of its own until they are written.
HELD_DOCS = 500
#: Bytes of a row group of the index, which a writer holds until it is full.
GROUP_BYTES = 1 << 24
#: Bytes of terms are ASCII letters and digits and all bytes beyond ASCII; only A-Z are lower-cased.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_slices(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a slice at a time."""
    raw = (text or "").encode().translate(TERM_BYTES)
    begin = 0
    while begin < len(raw):
        end = raw.find(b" ", begin + SLICE)
        end = len(raw) if end < 0 else end
        yield raw[begin:end].split()
        begin = end


def _item_terms(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        found = [(i, t) for i, text in enumerate(batch.column("text")) for part in term_slices(text.as_py()) for t in set(part)]
        ids = batch.column("item_id").take(pa.array([i for i, _ in found], pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array([t for _, t in found], pa.binary()).cast(pa.string())], ["item_id", "term"])


def _held_terms(vocabulary):
    """(doc_id, n, terms, times) of each document; terms are those of the vocabulary, or all without one."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = vocabulary.value if vocabulary else None
        for whole in source:
            for first in range(0, len(whole), HELD_DOCS):
                batch = whole.slice(first, HELD_DOCS)
                sizes, held = [], []
                for text in batch.column("text"):
                    size, counts = 0, Counter()
                    for part in term_slices(text.as_py()):
                        size += len(part)
                        counts.update(part if wanted is None else filter(wanted.__contains__, part))
                    sizes.append(size)
                    held.append(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array([list(c) for c in held], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                        pa.array([list(c.values()) for c in held], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "times"],
                )

    return run


def index(docs: DataFrame, terms: DataFrame, most_terms: int = LOOKUP_ROWS) -> DataFrame:
    """Documents (doc_id, n) with their query terms and how often they hold them, staged."""
    vocabulary = None
    if terms.count() <= most_terms:  # bounds what is collected
        vocabulary = docs.sparkSession.sparkContext.broadcast(frozenset(t["term"].encode() for t in terms.collect()))
    source = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = source.mapInArrow(_held_terms(vocabulary), "doc_id long, n long, terms array<string>, times array<long>")
    return stage(held, "held-terms", {"parquet.block.size": str(GROUP_BYTES)})


class Asked(NamedTuple):
    """Items with the numbers of their terms, rarest first, and the weights of the terms."""

    items: list[str]
    terms: list[np.ndarray]
    weights: np.ndarray
    number: dict[str, int]


def asked(rows: list) -> Asked:
    """From rows (item_id, term, w, df)."""
    rows = sorted(rows, key=lambda r: (r["item_id"], r["df"], r["term"]))
    number = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
    weights = np.zeros(len(number), np.int64)
    items: dict[str, list[int]] = {}
    for r in rows:
        weights[number[r["term"]]] = r["w"]
        items.setdefault(r["item_id"], []).append(number[r["term"]])
    return Asked(list(items), [np.array(t) for t in items.values()], weights, number)


class Block(NamedTuple):
    """Postings of a block of documents by term number: documents' places and contributions (times the weight)."""

    begins: np.ndarray
    places: np.ndarray
    parts: np.ndarray
    most: np.ndarray


def block_of(batch: pa.RecordBatch, query: Asked, n_docs: int, all_terms: int) -> Block:
    lists = batch.column("terms")
    encoded = lists.flatten().dictionary_encode()
    known = np.array([query.number.get(t, -1) for t in encoded.dictionary.to_pylist()], np.int64)
    term = known[encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)] if len(known) else np.zeros(0, np.int64)
    place = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    use = np.flatnonzero(term >= 0)
    use = use[np.argsort(term[use], kind="stable")]
    term, place, times = term[use], place[use], batch.column("times").flatten().to_numpy()[use]
    m = 50 + (50 * batch.column("n").to_numpy() * n_docs) // max(1, all_terms)
    parts = query.weights[term] * ((1_000_000_000 * times) // (1000 * times + 20 * m[place]))
    begins = np.searchsorted(term, np.arange(len(query.weights) + 1))
    most = np.zeros(len(query.weights), np.int64)
    np.maximum.at(most, term, parts)
    return Block(begins, place, parts, most)


def scores_in(block: Block, size: int, terms: np.ndarray, k: int, found: int) -> np.ndarray:
    """Scores of the block's documents for one item; 0 for documents that cannot reach the k best (or hold no term).

    ``found`` is a score that k documents elsewhere reach (0 if there are none).
    """
    scores, creating = np.zeros(size, np.int64), True
    to_come = int(block.most[terms].sum())
    for term in terms:
        at = slice(block.begins[term], block.begins[term + 1])
        places, parts = block.places[at], block.parts[at]
        if creating and to_come < found:
            creating = False
        elif creating and to_come < scores.max(initial=0) and size >= k:
            creating = to_come >= np.partition(scores, size - k)[size - k]
        if not creating:
            held = scores[places] > 0
            places, parts = places[held], parts[held]
        scores[places] += parts
        to_come -= int(block.most[term])
    return scores


def _best(query, k: int, n_docs: int, all_terms: int):
    """(item_id, doc_id, score): the k best documents of a task for each item."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = query.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in wanted.items]
        for batch in source:
            ids = batch.column("doc_id").to_numpy()
            block = block_of(batch, wanted, n_docs, all_terms)
            for i, terms in enumerate(wanted.terms):
                docs, scores = best[i]
                found = int(scores[-1]) if len(scores) == k else 0
                fresh = scores_in(block, len(ids), terms, k, found)
                places = np.flatnonzero((fresh > 0) & (fresh >= found))
                if not len(places):
                    continue
                docs, scores = np.concatenate((docs, ids[places])), np.concatenate((scores, fresh[places]))
                order = np.lexsort((docs, -scores))[:k]
                best[i] = docs[order], scores[order]
        sizes = [len(d) for d, _ in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(wanted.items, object), sizes), pa.string()),
                pa.array(np.concatenate([d for d, _ in best] or [np.zeros(0, np.int64)])),
                pa.array(np.concatenate([s for _, s in best] or [np.zeros(0, np.int64)])),
            ],
            ["item_id", "doc_id", "score"],
        )

    return run


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, most_terms: int = LOOKUP_ROWS, per_pass: int = ASKED) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of every item."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    source = items.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    queries = stage(source.mapInArrow(_item_terms, "item_id string, term string").distinct(), "item-terms")
    vocabulary = queries.select("term").distinct()
    held = index(docs, vocabulary, most_terms)
    n_docs, all_terms = held.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).head()
    frequencies = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    # Fixed formula: doubles in the logarithm, 64-bit integers elsewhere.
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighed = queries.join(frequencies, "term").select("item_id", "term", "df", weight.alias("w")).filter("w > 0")
    passes = queries.count() // per_pass + 1
    weighed = stage(weighed.withColumn("pass", F.expr(f"pmod(xxhash64(item_id), {passes})")), "weighed-terms")
    found = spark.createDataFrame([], "item_id string, doc_id long, score long")
    for turn in range(passes):
        query = spark.sparkContext.broadcast(asked(weighed.filter(F.col("pass") == turn).collect()))  # per_pass bounds it
        found = found.unionByName(held.mapInArrow(_best(query, k, n_docs, all_terms), "item_id string, doc_id long, score long"))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    best = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return best.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")


#: The whole contract for small tables: every document is scored for every item.
SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), docs AS (SELECT doc_id, len(terms)::BIGINT AS n, terms FROM words WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
held AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM held, totals GROUP BY term, n_docs
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id
), places AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM places WHERE rank <= 50
"""

"""Spelling variants: words that differ in one inserted, deleted or replaced code point, by pairs of trie nodes.

The words are numbered as nodes of two tries, one of the words and one of the reversed words. A word is the pair (prefix node,
suffix node) of each of its splits; leaving a position out gives the pair around it. Two words of one length are near if they have such
a pair around the same position in common; a word is near one that is longer by one if one of its splits is a pair of
that. Node numbers stand for whole strings, so equal pairs are near words without a further check. Where equal letters stand in a
row, only the pair around the last one is joined with splits: two words meet in one pair only.

A trie is built from words in order: partitions are ranges of words, and a node is new where a word leaves the path of the word
before it. Only prefixes that two partitions share are numbered beforehand, from the first and last words of the partitions.
A pair holds at most one word for each letter at its position and one shorter word, so no pair is hot, however frequent
a word is: counts are summed before anything else.

A form's count is at least ``ratio`` times that of the word, so chains of forms have no more links than a logarithm of
the largest count; they are followed by joins that double their reach. Null texts have no words; a null ``doc_id`` hashes as an empty one;
repeated rows count each; extra columns are ignored; an empty table gives no rows. Texts and words of any length are taken whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import batches as B
from seriesmill.session import stage

#: Letters of words are A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; one in ``SLIP`` loses a letter.
WORD_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
SLIP = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
SLICE = 1 << 20
#: Words of one range partition of a trie, pairs of one bucket, and list entries of one batch of pairs.
WORDS_PER_PART = 100_000
PAIRS_PER_BUCKET = 400_000
SPLIT, AROUND, AROUND_LAST = 0, 1, 2


def slipped(doc_id: str, run: bytes) -> bytes:
    """The run, less one code point where the checksum of document and run says so."""
    check = zlib.crc32(run.decode("latin-1").encode(), zlib.crc32(f"{doc_id}:".encode()))
    if check % SLIP:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1 :]


def _runs(least: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()

        def out():
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in source:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                raw = (text.as_py() or "").encode("latin-1", "replace").translate(WORD_LETTERS)
                begin = 0
                while begin < len(raw):
                    end = raw.find(b" ", begin + SLICE)
                    end = len(raw) if end < 0 else end
                    for word, n in Counter(raw[begin:end].split()).items():
                        if len(word) >= least and len(word := slipped(doc_id, word)) >= least:
                            total[word] += n
                    begin = end
                if len(total) > 200_000:
                    yield out()
                    total.clear()
        yield out()

    return run


def counted_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all documents."""
    source = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    words = source.mapInArrow(_runs(least_length), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    least = min(len(a), len(b))
    return next((i for i in range(least) if a[i] != b[i]), least)


def node_paths(words: list[str], first: int, anchors: list[tuple[str, list[int]]]) -> Iterator[list[int]]:
    """Trie nodes of all prefixes of sorted words, the empty one (0) included.

    New nodes get numbers from ``first`` on; ``anchors`` are strings whose prefixes have their numbers already.
    """
    path, before = [0], ""
    for word in words:
        del path[common(before, word) + 1 :]
        known = max((numbers[: common(word, anchor)] for anchor, numbers in anchors), key=len, default=[])
        path.extend(known[len(path) - 1 :])
        fresh = len(word) + 1 - len(path)
        path.extend(range(first, first + fresh))
        first, before = first + fresh, word
        yield list(path)


def _numbered(limits: dict):
    """One range of sorted words: id of each word, the nodes of its prefixes, whether a letter ends its run of equal ones."""

    def run(key, table):
        begin, first, anchors = limits[key[0].as_py()]
        order = np.argsort(table.column("place").to_numpy())
        words = [w.as_py() for w in table.column("word").take(pa.array(order))]
        paths = list(node_paths(words, first, anchors))
        kind = pa.list_(pa.int64())
        return pa.table(
            {
                "id": pa.array(np.arange(begin, begin + len(words))),
                "own": table.column("own").take(pa.array(order)),
                "n": table.column("n").take(pa.array(order)),
                "nodes": pa.array(paths, kind),
                "lasts": pa.array([[a != b for a, b in zip(w, w[1:] + "\0")] for w in words], pa.list_(pa.bool_())),
            }
        )

    return run


def numbered(words: DataFrame, per_part: int = WORDS_PER_PART) -> DataFrame:
    """(id, own, n, nodes, lasts) of the trie of ``word``; ids follow the order of the words. ``own`` and ``n`` go along."""
    parts = max(1, words.count() // per_part + 1)
    ranged = words.repartitionByRange(parts, "word").sortWithinPartitions("word")
    ranged = ranged.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    ranged = stage(ranged, "sorted-words")
    ends = ranged.groupBy("part").agg(
        F.count("*").alias("n"), F.sum(F.length("word")).alias("size"), F.min("word").alias("first"), F.max("word").alias("last")
    )
    limits, begin, node, last, path = {}, 0, 1, "", []
    for row in sorted(ends.collect(), key=lambda r: r["part"]):  # one row for each range of words
        deep = common(last, row["first"])
        before = (last[:deep], path[:deep])
        # The last word's path may go on in later ranges: it is numbered here, after the range's own nodes.
        own, last = node + row["size"], row["last"]
        path = before[1][: common(before[0], last)]
        path = path + list(range(own, own + len(last) - len(path)))
        limits[row["part"]] = (begin, node, [before, (last, path)])
        begin, node = begin + row["n"], own + len(last)
    schema = "id long, own string, n long, nodes array<long>, lasts array<boolean>"
    return ranged.groupBy("part").applyInArrow(_numbered(limits), schema)


def _around(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))


def _pairs(buckets: int):
    """Rows (bucket, p, s, ids, ns, kinds) of the splits and the pairs around each position of the words of a batch."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids, ns = batch.column("id").to_numpy(), batch.column("n").to_numpy()
            (fore, begins), (back, _), (lasts, _) = (_around(batch.column(c)) for c in ("prefixes", "suffixes", "lasts"))
            row = 0
            while row < len(ids):
                stop = max(row + 1, int(np.searchsorted(begins, begins[row] + PAIRS_PER_BUCKET // 2, "right")) - 1)
                stop = min(stop, len(ids))
                nodes = np.diff(begins[row : stop + 1])
                word = np.repeat(np.arange(row, stop), nodes)
                depth = np.arange(len(word)) - np.repeat(np.cumsum(nodes) - nodes, nodes)
                length = nodes[word - row] - 1
                at = begins[word] + depth
                inner = depth < length
                p = np.concatenate((fore[at], fore[at[inner]]))
                s = np.concatenate((back[begins[word] + length - depth], back[(begins[word] + length - depth - 1)[inner]]))
                # Each word has one letter less than nodes.
                kind = np.where(lasts[(at - word)[inner]], AROUND_LAST, AROUND)
                kind = np.concatenate((np.full(len(word), SPLIT), kind)).astype(np.int8)
                word = np.concatenate((word, word[inner]))
                keys = B.mix(p.view(np.uint64) * B.GOLDEN + s.view(np.uint64))
                order, limits = B.cut_by_bucket(keys, buckets)
                held = np.flatnonzero(np.diff(limits))
                offsets = np.concatenate(([0], limits[1:][held]))
                columns = [p[order], s[order], ids[word[order]], ns[word[order]], kind[order]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held.astype(np.int64)), *[B.lists(c, offsets) for c in columns]], ["bucket", "p", "s", "ids", "ns", "kinds"]
                )
                row = stop

    return run


def near_in_pairs(p, s, ids, ns, kinds) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id, near words, count and id of the most frequent of them) for every entry that meets near words in its pair."""
    order = np.lexsort((ids, -ns, s, p))
    p, s, ids, ns, kinds = (c[order] for c in (p, s, ids, ns, kinds))
    fresh = np.concatenate((np.ones(min(1, len(p)), bool), (p[1:] != p[:-1]) | (s[1:] != s[:-1])))
    first = np.flatnonzero(fresh)
    group = np.cumsum(fresh) - 1
    groups, place = len(first), np.arange(len(p))
    none = len(p)
    n_at, id_at = np.append(ns, -1), np.append(ids, -1)

    def leader(mask: np.ndarray) -> np.ndarray:
        out = np.full(groups, none)
        out[group[mask][::-1]] = place[mask][::-1]
        return out

    around, last, split = kinds != SPLIT, kinds == AROUND_LAST, kinds == SPLIT
    best = leader(around)
    second = leader(around & (place != best[group]))
    best_last, short = leader(last), leader(split)
    n_around, n_last = np.bincount(group[around], minlength=groups), np.bincount(group[last], minlength=groups)
    # Another word of the same length, the shorter word, and for the shorter word the longer ones.
    other = np.where(place == best[group], second[group], best[group])
    shorter = np.where(last, short[group], none)
    # Entries of a pair are in order of preference, so the earlier place is the better form.
    form = np.where(split, best_last[group], np.minimum(other, shorter))
    near = np.where(split, n_last[group], n_around[group] - 1 + (shorter != none))
    use = near > 0
    return ids[use], near[use], n_at[form[use]], id_at[form[use]]


def _near(key, table):
    flat = [table.column(c).combine_chunks().flatten().to_numpy() for c in ("p", "s", "ids", "ns", "kinds")]
    ids, near, best_n, best_id = near_in_pairs(*flat)
    return pa.table({"id": ids, "near": near.astype(np.int64), "best_n": best_n, "best_id": best_id})


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of the words that have a form, by doubling the reach of pointers."""
    pointers = stage(forms.select("id", F.col("form_id").alias("root")), "form-pointers")
    while True:
        above = pointers.select(F.col("id").alias("root"), F.col("root").alias("above"))
        jumped = pointers.join(above, "root", "left")
        jumped = stage(jumped.select("id", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "form-pointers")
        pointers = jumped.select("id", "root")
        if not jumped.filter("moved").head(1):
            return pointers


def near_words(words: DataFrame, per_part: int = WORDS_PER_PART, per_bucket: int = PAIRS_PER_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(id, word, n) of the given (word, n), and (id, n_near, best) of those with near words; best is (n, -id) of the first in preference."""
    forward = stage(numbered(words.select("word", F.col("word").alias("own"), "n"), per_part), "prefix-nodes")
    backward = forward.select(F.reverse("own").alias("word"), F.col("id").cast("string").alias("own"), "n")
    backward = numbered(backward, per_part).select(F.col("own").cast("long").alias("id"), F.col("nodes").alias("suffixes"))
    both = forward.select("id", "n", F.col("nodes").alias("prefixes"), "lasts").join(backward, "id")
    total = forward.agg(F.sum(2 * F.size("nodes"))).head()[0] or 0
    buckets = max(8, total // per_bucket + 1)
    schema = "bucket long, p array<long>, s array<long>, ids array<long>, ns array<long>, kinds array<byte>"
    pairs = both.mapInArrow(_pairs(buckets), schema)
    near = pairs.groupBy("bucket").applyInArrow(_near, "id long, near long, best_n long, best_id long")
    best = F.max(F.struct(F.col("best_n").alias("n"), (-F.col("best_id")).alias("minus_id"))).alias("best")
    return forward.select("id", F.col("own").alias("word"), "n"), near.groupBy("id").agg(F.sum("near").alias("n_near"), best)


def variants(docs: DataFrame, ratio: int = RATIO, **sizes: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents."""
    words, near = near_words(stage(counted_words(docs), "word-counts"), **sizes)
    joined = stage(words.join(near, "id", "left"), "near-words")
    has_form = F.col("best.n") >= ratio * F.col("n")
    forms = joined.filter(has_form).select("id", (-F.col("best.minus_id")).alias("form_id"))
    roots = stage(forms.join(_roots(forms), "id"), "forms")
    own = joined.select("id", "word")
    form = own.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root = own.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    named = roots.join(form, "form_id").join(root, "root").select("id", "form", "root_word")
    return joined.join(named, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best.n")).alias("form_n"),
    )

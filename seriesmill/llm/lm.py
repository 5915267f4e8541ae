"""Scores of documents under an n-gram model of order three, kept as Elias-Fano tries in shards.

Tokens are words between white space (A-Z lower-cased) and one end for each text. Absolute discounting is interpolated over
three orders: P3(w|u,v) = q3 + b3 * P2(w|v), P2(w|v) = q2 + b2 * P1(w), P1(w) = (c + 1) / (N + V + 1) with exact counts of
all words. q is the discounted share of the training n-gram, b what the discounts take from all of its context. A pair counts once for each word that
it follows (Kneser-Ney), so that repeated passages do not rule the lower order. Discounts for
one, two and more occurrences are estimated from the numbers of n-grams that occur once to four times. Each q and b takes two bytes; both are rounded down, so
that the probabilities after any context add up to at most one. Every n-gram of the training texts is in the model.

The triples of all documents are shuffled once, to the shard of their middle word. A shard counts its training triples, lays
them out as a trie (word before -> word two before -> successors; monotone pointers and successors in Elias-Fano form) and
looks up the distinct triples of all documents in the packed form, through a memory map, each successor among those of its
context only. A shard needs memory for its own triples only. What follows a word with more than ``limit`` training occurrences is dealt
to several shards by the word before it, and, where that pair has about as many itself, by chunk. The counts of such pairs and triples are added up over
all shards, each in one of some groups, and go back to the shards that have them, with the totals of their contexts; so do the numbers of n-grams
behind the discounts. So the model is that of all training texts: it depends neither on the shards nor on what is dealt out.

Words are 63-bit hashes; up to ``FREQUENT`` frequent ones have a short number instead, which only makes rows smaller. A token of any
other word goes on, with q and b, to the table of counts of all words, where its P1 is known. Equality of words and
contexts rests on these hashes.

Nulls and empty texts are the end alone. Equal documents get equal scores. A null ``doc_id`` is dropped; rows that repeat a
``doc_id`` are parts of one document: one row, with sums over them. With no training text the base is that of empty counts. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import batches as B
from seriesmill.llm import trie
from seriesmill.session import stage

#: Words with a short number, at most; the table of them (16 bytes each) is sent to all tasks.
FREQUENT = (1 << 19) - 1
PAIRS_PER_SHARD = 500_000
#: Shards for each group that adds up counts over shards; every shard sends a row to every group.
SHARDS_PER_MERGE = 32
WORDS_PER_SHARD = 1_000_000
#: Words whose occurrences are dealt to several shards have more of them than this, and than one in 65,536 of all tokens.
PART = 250_000
#: A discount is at least the first, and at most the second share of the count (of three for larger counts).
DISCOUNTS = (0.1, 0.95)
#: Text that is hashed at once; it takes some 60 times as much memory.
SLICE_BYTES = 1 << 20
#: Documents of a chunk, whose places then take one byte.
MOST_DOCS = 1 << 8
#: Hashes of words have this bit, so they are above all short numbers; the number 0 stands before the text.
HASHED = np.uint64(1 << 20)
START = np.uint64(0)
END = B.mix(np.array([0xE0D], np.uint64))[0] | HASHED
HELD_OUT = "pmod(crc32(cast(coalesce(cast(doc_id AS string), '') AS binary)), 7) = 2"
SUMS = ("n_tokens", "n_known", "base")
#: Counts of words below this have a bin of their own in the table of counts; above, eight bins an octave.
PLAIN_BINS = 256


def tokens(texts: B.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of a chunk, ends included, and where each text begins."""
    found = B.words(texts)
    rows = texts.last - texts.first
    offsets = found.offsets + np.arange(rows + 1)
    out = np.empty(offsets[-1], np.uint64)
    ends = offsets[1:] - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner], out[ends] = found.hashes | HASHED, END
    return out, offsets


def _chunks(batch: pa.RecordBatch, limit: int):
    for texts in B.chunks(batch.column("text"), limit):
        for first in range(texts.first, texts.last, MOST_DOCS):
            last = min(first + MOST_DOCS, texts.last)
            cut = texts.offsets[first - texts.first : last - texts.first + 1]
            yield B.Texts(texts.data[cut[0] : cut[-1]], cut - cut[0], first, last)


def count_bins(counts: np.ndarray) -> np.ndarray:
    high = PLAIN_BINS + np.floor(8 * np.log2(np.maximum(counts, PLAIN_BINS) / PLAIN_BINS)).astype(np.int64)
    return np.where(counts < PLAIN_BINS, counts, high)


def _merge(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    joined, held = np.concatenate(words), np.concatenate(counts)
    order = np.argsort(joined)
    joined, held = joined[order], held[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(joined)), bool), joined[1:] != joined[:-1])))
    return joined[first], np.add.reduceat(held, first) if len(first) else held


def _count_words(buckets: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, held = [], [], 0

        def out():
            found, sums = _merge(words, counts)
            bucket, first = np.unique(_range(found, buckets), return_index=True)
            limits = np.append(first, len(found))
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket), B.lists(found.view(np.int64), limits), B.lists(sums, limits)], ["bucket", "words", "counts"]
            )

        for batch in source:
            for texts in B.chunks(batch.column("text"), SLICE_BYTES):
                found, sums = np.unique(tokens(texts)[0], return_counts=True)
                words.append(found)
                counts.append(sums)
                held += len(found)
                if held > 4_000_000:
                    merged = _merge(words, counts)
                    words, counts, held = [merged[0]], [merged[1]], len(merged[0])
                    if held > 2_000_000:
                        yield out()
                        words, counts, held = [], [], 0
        if words:
            yield out()

    return run


def _sum_words(key, table):
    words = table.column("words").combine_chunks().flatten().to_numpy().view(np.uint64)
    found, sums = _merge([words], [table.column("counts").combine_chunks().flatten().to_numpy()])
    bins, kinds = np.unique(count_bins(sums), return_counts=True)
    one, few = np.array([0, len(found)]), np.array([0, len(bins)])
    return pa.table(
        {
            "bucket": pa.array([key[0].as_py()]),
            "words": B.lists(found.view(np.int64), one),
            "counts": B.lists(sums.astype(np.int64), one),
            "n": pa.array([int(sums.sum())]),
            "v": pa.array([len(found)]),
            "bins": B.lists(bins, few),
            "kinds": B.lists(kinds, few),
        }
    )


def _frequent(least: int):
    """Words from a bin of counts on, one row each."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            words, counts = batch.column("words").flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            held = count_bins(counts) >= least
            yield pa.RecordBatch.from_arrays([pa.array(words[held]), pa.array(counts[held])], ["word", "times"])

    return run


def _base(log_one: float, counts: np.ndarray) -> np.ndarray:
    return np.log10(counts + 1) - log_one


def log_one(n: int, v: int) -> float:
    return float(np.log10(n + v + 1))


class Frequent:
    """The frequent words with their short numbers and counts, and the sizes of the corpus; the same everywhere."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n: int, v: int):
        rank = np.lexsort((words, -counts))
        #: By short number, the most frequent first; 0 is the start of a text, which is followed as often as there are ends.
        self.counts = np.concatenate((counts[words == END][:1], np.zeros(1, np.int64)))[:1].astype(np.int64)
        self.counts = np.concatenate((self.counts, counts[rank].astype(np.int64)))
        order = np.argsort(words[rank])
        self.words, self.numbers = words[rank][order], (order + 1).astype(np.uint64)
        self.n, self.v, self.limit = n, v, max(PART, n >> 16)
        self.pairs, self.pieces = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def wide(self, codes: np.ndarray) -> np.ndarray:
        """Whether what follows a word is dealt to several shards."""
        return self.count(codes) > self.limit

    def with_pairs(self, pairs: np.ndarray, counts: np.ndarray) -> Frequent:
        """The same with the pairs of frequent words that are dealt out too, and about how often they occur."""
        order = np.argsort(pairs)
        self.pairs, self.pieces = pairs[order], (counts[order] // self.limit + 2).astype(np.uint64)
        return self

    def parts(self, second: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Parts of what follows each pair of words: more than one if the pair is dealt out."""
        out = np.ones(len(first), np.uint64)
        if len(self.pairs):
            key = _pair(second, first)
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            found = (self.pairs[at] == key) & (first < HASHED) & (second < HASHED)
            out[found] = self.pieces[at[found]]
        return out

    def code(self, hashes: np.ndarray) -> np.ndarray:
        """Short numbers of frequent words; others keep their hash."""
        if not len(self.words):
            return hashes
        kinds, group = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, kinds), len(self.words) - 1)
        return np.where(self.words[at] == kinds, self.numbers[at], kinds)[group]

    def count(self, codes: np.ndarray) -> np.ndarray:
        """Training counts of words with a short number; 0 for others."""
        return self.counts[np.where(codes < HASHED, codes, 0).astype(np.int64)] * (codes < HASHED)

    def p1(self, codes: np.ndarray) -> np.ndarray:
        return (self.count(codes) + 1) / (self.n + self.v + 1)

    def shard(self, second: np.ndarray, first: np.ndarray, chunk: int, shards: int) -> np.ndarray:
        """Shard of a token of a chunk by the two tokens before it, the nearest last."""
        part = np.zeros(len(first), np.uint64)
        wide = np.flatnonzero(self.wide(first))
        piece = B.mix(np.array([chunk + 1], np.uint64)) % self.parts(second[wide], first[wide])
        pieces = (self.count(first[wide]) // self.limit + 1).astype(np.uint64)
        part[wide] = B.mix(second[wide] + piece * B.GOLDEN) % pieces + np.uint64(1)
        return _range(B.mix(B.mix(first) + part * B.GOLDEN), shards)


def _pair(second: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number for two short numbers."""
    return (second << np.uint64(20)) | first


def _range(mixed: np.ndarray, buckets: int) -> np.ndarray:
    return (((mixed >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _before(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The token before each token; the start of a text before its first."""
    out = np.concatenate(([START], codes[:-1]))
    out[offsets[:-1]] = START
    return out


def _planes(columns: list[np.ndarray]) -> np.ndarray:
    """Columns of numbers as planes of bytes, so that the empty bytes of short numbers compress to nothing."""
    return np.concatenate([np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T for c in columns])


def _numbers(planes: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


#: Entropy coding pays for what goes through the shuffle: the bytes of frequent numbers are far from evenly used.
CODEC = pa.Codec("zstd", 1)
#: Shorter values are left to the codec of the shuffle, which sees many of them at once.
PACKED_BYTES = 1 << 10


def _packed(planes: np.ndarray) -> bytes:
    """Length of the planes, and the planes, compressed if they are long."""
    data = planes.tobytes()
    return len(data).to_bytes(4, "little") + (data if len(data) < PACKED_BYTES else CODEC.compress(data, asbytes=True))


def _size(blob: bytes) -> int:
    return int.from_bytes(blob[:4], "little")


def _unpacked(blob: bytes) -> np.ndarray:
    size, data = _size(blob), memoryview(blob)[4:]
    return np.frombuffer(data if size < PACKED_BYTES else CODEC.decompress(data, size), np.uint8)


def _parts(place: np.ndarray, score: np.ndarray, known: np.ndarray, base: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """What documents of chunks get from a shard or from the counts of words: one value for each run of ``cut``."""
    columns = [place.astype(np.uint8), score.astype(np.float32), known.astype(np.float32), base.astype(np.float64)]
    planes = _planes(columns)
    return [_packed(planes[:, a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _columns(blobs: list[bytes], kinds: tuple[type, ...]) -> list[np.ndarray]:
    """The columns of values that were written as planes, one after another."""
    sizes = [np.dtype(kind).itemsize for kind in kinds]
    width = sum(sizes)
    planes = np.concatenate([np.zeros((width, 0), np.uint8), *(_unpacked(b).reshape(width, -1) for b in blobs)], axis=1)
    ends = np.cumsum(sizes)
    return [_numbers(planes[end - size : end], kind) for kind, size, end in zip(kinds, sizes, ends, strict=True)]


def _parts_read(blobs: list[bytes]) -> list[np.ndarray]:
    """(place, score, known, base) of all documents in the values."""
    return _columns(blobs, (np.uint8, np.float32, np.float32, np.float64))


def _tokens_read(blobs: list[bytes]) -> list[np.ndarray]:
    """(code, chunk, place, q, b) of tokens that still need a count."""
    return _columns(blobs, (np.uint64, np.int64, np.uint8, np.float32, np.float32))


def _triples(shards: int, frequent):
    """Rows of a chunk: its triples by shard; the first row has the sums of its documents that need no shard."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = frequent.value
        one = log_one(model.n, model.v)
        for batch in source:
            all_ids, train = batch.column("doc_id").to_numpy(), batch.column("train").to_numpy(zero_copy_only=False)
            for texts in _chunks(batch, SLICE_BYTES):
                found, offsets = tokens(texts)
                rows = texts.last - texts.first
                # Documents that train come first, so that a row needs their number only.
                own = train[texts.first : texts.last]
                place = np.empty(rows, np.int64)
                place[np.argsort(~own, kind="stable")] = np.arange(rows)
                row = np.repeat(place, np.diff(offsets))
                ids = np.empty(rows, np.int64)
                ids[place] = all_ids[texts.first : texts.last]
                code = model.code(found)
                known, counts = code < HASHED, model.count(code)
                sums = [
                    np.bincount(row, minlength=rows).astype(np.float64),
                    np.bincount(row, weights=known, minlength=rows),
                    np.bincount(row, weights=np.where(known, _base(one, counts), 0.0), minlength=rows),
                ]
                first = _before(code, offsets)
                second = _before(first, offsets)
                chunk = batch.column("row")[texts.first].as_py()
                shard = model.shard(second, first, chunk, shards)
                order = np.argsort((shard.astype(np.uint64) << np.uint64(40)) | (B.mix(first) >> np.uint64(24)))
                planes = _planes([first[order], second[order], code[order], row[order].astype(np.uint8)])
                held, cut = np.unique(shard[order], return_index=True)
                cut = np.append(cut, len(order))
                trained = np.uint16(own.sum()).tobytes()
                data = [trained + _packed(planes[:, a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                one_row = np.minimum(np.arange(len(held) + 2), 1) * rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(held[:1], held)),
                        pa.array(np.full(len(held) + 1, chunk)),
                        pa.array([trained, *data], pa.binary()),
                        B.lists(ids, one_row),
                        *[B.lists(x, one_row) for x in sums],
                    ],
                    ["bucket", "chunk", "data", "ids", *SUMS],
                )

    return run


def _triples_read(table):
    """(first, second, code, place, row, train) of the triples of a shard; ``row`` is the place of their row in it."""
    blobs = table.column("data").to_pylist()
    trained = np.array([int.from_bytes(b[:2], "little") for b in blobs])
    first, second, code, place = _columns([memoryview(b)[2:] for b in blobs], (np.uint64, np.uint64, np.uint64, np.uint8))
    row = np.repeat(np.arange(len(blobs)), [_size(b[2:6]) // 25 for b in blobs])
    return first, second, code, place, row, place < trained[row]


class Dealt:
    """Pairs and triples of a shard whose contexts are dealt to several shards, by the group that adds up their counts."""

    def __init__(self, grams: Grams, model: Frequent, merges: int):
        wide, deep = model.wide(grams.firsts), model.parts(*grams.context_words()) > 1
        self.wide, self.deep = np.flatnonzero(wide), np.flatnonzero(deep)
        near, far = np.flatnonzero(wide[grams.near_first]), np.flatnonzero(deep[grams.pair])
        self.near = self._by_group(near, grams.near_grams(near), merges)
        self.far = self._by_group(far, grams.far_grams(far)[1:], merges)

    @staticmethod
    def _by_group(places: np.ndarray, words: tuple[np.ndarray, np.ndarray], merges: int) -> list[np.ndarray]:
        group = _range(B.mix(B.mix(words[0]) + words[1] * B.GOLDEN), merges)
        order = np.argsort(group, kind="stable")
        return np.split(places[order], np.searchsorted(group[order], np.arange(1, merges)))


def _steps(columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """Sorted columns of words by their differences, and counts."""
    return _packed(_planes([*(np.diff(c, prepend=np.uint64(0)) for c in columns), counts.astype(np.int64)]))


def _steps_read(blobs: list[bytes], width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of such values, one value after another, and the length of each value."""
    sizes = np.array([_size(b) for b in blobs]) // (8 * width + 8)
    *columns, counts = _columns(blobs, (np.uint64,) * width + (np.int64,))
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(c, dtype=np.uint64))) for c in columns]
    start = np.cumsum(sizes) - sizes
    return [*(total[1:] - np.repeat(total[start], sizes) for total in sums), counts], sizes


def _count_shard(frequent, merges: int):
    """What other shards need of this one: its counts for contexts that are dealt out, and how many others have which count."""

    def run(key, table):
        model = frequent.value
        first, second, code, _, _, train = _triples_read(table)
        grams = Grams(first, second, code, train)
        dealt = Dealt(grams, model, merges)
        deep = np.zeros(len(grams.contexts), bool)
        deep[dealt.deep] = True
        wide = np.zeros(len(grams.firsts), bool)
        wide[dealt.wide] = True
        near = np.bincount(grams.near, weights=(grams.counts > 0) & ~deep[grams.pair], minlength=len(grams.near_first))
        times = np.concatenate((_times(near[~wide[grams.near_first]]), _times(grams.counts[~deep[grams.pair]])))
        pairs = _pair(*(c[dealt.deep] for c in grams.context_words()))
        shard = key[0].as_py()
        return pa.table(
            {
                "bucket": pa.array(np.arange(merges)),
                "shard": pa.array(np.full(merges, shard)),
                "near": pa.array([_steps(grams.near_grams(at), near[at]) for at in dealt.near], pa.binary()),
                "far": pa.array([_steps(grams.far_grams(at), grams.counts[at]) for at in dealt.far], pa.binary()),
                "wide": pa.array([grams.firsts[dealt.wide].astype(np.int64)] * merges, pa.list_(pa.int64())),
                "deep": pa.array([pairs.astype(np.int64)] * merges, pa.list_(pa.int64())),
                # One group adds up a shard's numbers.
                "times": pa.array([times * (m == shard % merges) for m in range(merges)], pa.list_(pa.int64())),
            }
        )

    return run


def _merge_counts(key, table):
    """Counts over all shards of the pairs and triples that were sent, a row for each shard, in the order it sent them.

    With them go the parts of this group in the totals of each context that the shard has, and in the numbers of counts.
    """
    (v, w, near), near_sizes = _steps_read(table.column("near").to_pylist(), 2)
    (u3, v3, w3, far), far_sizes = _steps_read(table.column("far").to_pylist(), 3)
    words, word = np.unique(np.concatenate((w, w3)), return_inverse=True)
    pairs, pair = np.unique(_pair(u3, v3), return_inverse=True)
    triples, triple = np.unique(_joint(pair, word[len(w) :], len(words)), return_inverse=True)
    far = np.bincount(triple, weights=far, minlength=len(triples)).astype(np.int64)
    owner = (triples // np.uint64(max(1, len(words)))).astype(np.int64)
    ends, end = np.unique(_joint(v, word[: len(w)], len(words)), return_inverse=True)
    near = np.bincount(end, weights=near, minlength=len(ends)).astype(np.int64)
    # A triple that is dealt out is one more word that its pair follows.
    own = _joint(pairs[owner] & np.uint64((1 << 20) - 1), triples % np.uint64(max(1, len(words))), len(words))[far > 0]
    near += np.bincount(np.searchsorted(ends, own), minlength=len(ends))
    firsts, first = np.unique(ends // np.uint64(max(1, len(words))), return_inverse=True)
    times = np.concatenate((_times(near), _times(far)))
    times += table.column("times").combine_chunks().flatten().to_numpy().reshape(-1, len(times)).sum(0)

    def cut(values, sizes):
        return [_packed(_planes([x])) for x in np.split(values, np.cumsum(sizes)[:-1])]

    def totals(contexts, sums, asked):
        contexts = contexts.astype(np.int64)
        out = []
        for wanted in asked.to_pylist():
            rows = np.zeros((len(wanted), 4), np.int64)
            if len(contexts) and wanted:
                at = np.minimum(np.searchsorted(contexts, wanted), len(contexts) - 1)
                rows = sums[at] * (contexts[at] == wanted)[:, None]
            out.append(_packed(_planes(list(rows.T))))
        return pa.array(out, pa.binary())

    return pa.table(
        {
            "bucket": table.column("shard"),
            "source": pa.array(np.full(len(table), key[0].as_py())),
            "near": pa.array(cut(near[end], near_sizes), pa.binary()),
            "far": pa.array(cut(far[triple], far_sizes), pa.binary()),
            "wide": totals(firsts, _totals(first, near, len(firsts)), table.column("wide")),
            "deep": totals(pairs, _totals(owner, far, len(pairs)), table.column("deep")),
            "times": pa.array([times] * len(table), pa.list_(pa.int64())),
        }
    )


def _score_shard(frequent, buckets: int, merges: int):
    """Build a shard's trie from its training triples and the counts of others, and score all its triples.

    A row for each row of the shard, with the scores of its documents, and one for each bucket of words, with the tokens
    that still need a count.
    """

    def run(key, table, merged):
        model = frequent.value
        chunks = table.column("chunk").to_numpy()
        first, second, code, place, row, train = _triples_read(table)
        q, b = shares(first, second, code, train, lambda grams: _whole(grams, model, merged, merges))
        del first, second, train
        known = code < HASHED
        logs = np.zeros(len(code))
        logs[known] = np.log10(q[known] + b[known] * model.p1(code[known]))
        docs, group = np.unique((row.astype(np.uint64) << np.uint64(16)) | place, return_inverse=True)
        cut = np.searchsorted(docs >> np.uint64(16), np.arange(len(chunks) + 1))
        zero = np.zeros(len(docs))
        scored = _parts(docs & np.uint64(0xFFFF), np.bincount(group, weights=logs, minlength=len(docs)), zero, zero, cut)

        rest = np.flatnonzero(~known)
        bucket = _range(code[rest], buckets)
        order = np.argsort(bucket, kind="stable")
        rest, (held, begin) = rest[order], np.unique(bucket[order], return_index=True)
        begin = np.append(begin, len(rest))
        columns = [code[rest], chunks[row[rest]], place[rest], q[rest].astype(np.float32), b[rest].astype(np.float32)]
        planes = _planes(columns)
        wanted = [_packed(planes[:, a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
        none = [None] * len(held)
        lists = {c: pa.concat_arrays([table.column(c).combine_chunks(), pa.nulls(len(held), table.column(c).type)]) for c in ("ids", *SUMS)}
        return pa.table(
            {
                "bucket": pa.array([*_range(B.mix(chunks.astype(np.uint64) + np.uint64(1)), buckets).tolist(), *held.tolist()], pa.int64()),
                "chunk": pa.array([*chunks.tolist(), *none], pa.int64()),
                "parts": pa.array([*scored, *none], pa.binary()),
                "tokens": pa.array([None] * len(chunks) + wanted, pa.binary()),
                **lists,
            }
        )

    return run


def _joint(owner: np.ndarray, follow: np.ndarray, kinds: int) -> np.ndarray:
    return owner.astype(np.uint64) * np.uint64(max(1, kinds)) + follow.astype(np.uint64)


def _times(counts: np.ndarray) -> np.ndarray:
    """How many n-grams occur once to four times."""
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5]


def discounts(times: np.ndarray) -> np.ndarray:
    """Absolute discounts of n-grams that occur once, twice and more often, by how many occur once to four times (after Chen and Goodman)."""
    share = times[0] / max(1, times[0] + 2 * times[1])
    grow = times[1:] / np.maximum(1, times[:3])
    low, high = DISCOUNTS
    return np.clip(np.arange(1, 4) - np.arange(2, 5) * share * grow, low, high * np.arange(1, 4))


def _totals(owner: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Of each context: the sum of its counts, and how many of them are one, two and more."""
    kinds = [np.bincount(owner[held], minlength=size) for held in (counts == 1, counts == 2, counts > 2)]
    return np.stack([np.bincount(owner, weights=counts, minlength=size).astype(np.int64), *kinds], 1)


class Grams:
    """Distinct triples of a shard with their training counts, their contexts and the pairs in them, all sorted."""

    def __init__(self, first: np.ndarray, second: np.ndarray, word: np.ndarray, train: np.ndarray):
        self.firsts, first = np.unique(first, return_inverse=True)
        self.seconds, second = np.unique(second, return_inverse=True)
        self.words, word = np.unique(word, return_inverse=True)
        kinds = np.uint64(max(1, len(self.words)))
        self.contexts, pair = np.unique(_joint(first, second, len(self.seconds)), return_inverse=True)
        del first, second
        keys, self.group = np.unique(_joint(pair, word, len(self.words)), return_inverse=True)
        #: Training counts of the triples, their contexts and words.
        self.counts = np.bincount(self.group, weights=train, minlength=len(keys)).astype(np.int64)
        self.pair, self.word = (keys // kinds).astype(np.int64), keys % kinds
        del keys
        #: The nearer word of each context, and its pair with the word of each triple.
        self.first = (self.contexts // np.uint64(max(1, len(self.seconds)))).astype(np.int64)
        near, self.near = np.unique(_joint(self.first[self.pair], self.word, len(self.words)), return_inverse=True)
        self.near_first, self.near_word = (near // kinds).astype(np.int64), near % kinds

    def context_words(self) -> tuple[np.ndarray, np.ndarray]:
        """The two words of each context, the nearer one last."""
        return self.seconds[(self.contexts % np.uint64(max(1, len(self.seconds)))).astype(np.int64)], self.firsts[self.first]

    def near_grams(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.firsts[self.near_first[at]], self.words[self.near_word[at].astype(np.int64)]

    def far_grams(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        context = self.pair[at]
        return *(c[context] for c in self.context_words()), self.words[self.word[at].astype(np.int64)]


class Counts:
    """Counts of the pairs and triples of a shard, totals of their contexts, and how many pairs and triples of all occur once to four times."""

    def __init__(self, grams: Grams):
        """As if there were no other shard."""
        self.near = np.bincount(grams.near, weights=grams.counts > 0, minlength=len(grams.near_first)).astype(np.int64)
        self.far = grams.counts
        self.near_totals = _totals(grams.near_first, self.near, len(grams.firsts))
        self.far_totals = _totals(grams.pair, self.far, len(grams.contexts))
        self.near_times, self.far_times = _times(self.near), _times(self.far)


def _whole(grams: Grams, model: Frequent, merged: pa.Table, merges: int) -> Counts:
    """Counts over all shards, from a shard's own and, where contexts are dealt out, those that the others helped to add up."""
    counts, dealt = Counts(grams), Dealt(grams, model, merges)
    times = np.zeros(8, np.int64)
    counts.near_totals[dealt.wide] = 0
    counts.far_totals[dealt.deep] = 0
    for part in merged.to_pylist():
        m = part["source"]
        times += part["times"]
        counts.near[dealt.near[m]], counts.far[dealt.far[m]] = (_columns([part[c]], (np.int64,))[0] for c in ("near", "far"))
        counts.near_totals[dealt.wide] += np.stack(_columns([part["wide"]], (np.int64,) * 4), 1)
        counts.far_totals[dealt.deep] += np.stack(_columns([part["deep"]], (np.int64,) * 4), 1)
    counts.near_times, counts.far_times = times[:4], times[4:]
    return counts


class Order:
    """One order of the trie: contexts, pointers to their successors, successors, and two bytes for each q and b."""

    def __init__(self, contexts: np.ndarray, universe: int, owner: np.ndarray, word: np.ndarray, counts: np.ndarray, totals: np.ndarray, times: np.ndarray, kinds: int):
        """Counted n-grams, sorted by the place of their context and by word; contexts lie below ``universe``, words below ``kinds``.

        What a context has left is what the discounts take from all its n-grams, of which some may be in other shards.
        """
        held = totals[:, 0] > 0
        self.size, self.kinds = int(held.sum()), kinds
        if not self.size:
            return
        seen, cuts = counts > 0, discounts(times)
        counts, owner, word = counts[seen], owner[seen], word[seen]
        codes = trie.quantise((counts - cuts[np.minimum(counts, 3) - 1]) / totals[owner, 0])
        left = trie.quantise(totals[held, 1:] @ cuts / totals[held, 0])
        owner, contexts = (np.cumsum(held) - 1)[owner], contexts[held]
        start, entries = np.searchsorted(owner, np.arange(self.size + 1)), _joint(owner, word, kinds)
        self.levels = [
            trie.encode(contexts, universe), trie.encode(start, len(entries) + 1), trie.encode(entries, self.size * kinds),
        ]
        self.arrays = [part for level in self.levels for part in (level.low, level.high, level.before)] + [codes, left]

    def ask(self, contexts: np.ndarray, owner: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(q, b) of words after contexts; ``owner`` is the place of each word's context in ``contexts``."""
        if not self.size:
            return np.zeros(len(word)), np.ones(len(word))
        with trie.mapped(self.arrays) as views:
            held, pointers, entries = (
                level._replace(low=views[3 * i], high=views[3 * i + 1], before=views[3 * i + 2]) for i, level in enumerate(self.levels)
            )
            at = trie.find(held, contexts)
            known = np.maximum(at, 0)
            first, last = trie.access(pointers, known).astype(np.int64), trie.access(pointers, known + 1).astype(np.int64)
            q, b = np.zeros(len(word)), np.where(at >= 0, trie.restore(views[-1][known]), 1.0)[owner]
            asked = np.flatnonzero(at[owner] >= 0)
            of = owner[asked]
            place = trie.find(entries, _joint(at[of], word[asked], self.kinds), first[of], last[of])
            q[asked[place >= 0]] = trie.restore(views[-2][place[place >= 0]])
        return q, b


def shares(
    first: np.ndarray, second: np.ndarray, word: np.ndarray, train: np.ndarray, whole: Callable[[Grams], Counts] = Counts
) -> tuple[np.ndarray, np.ndarray]:
    """(q, b) of each triple: the probability of ``word`` after ``second first`` is q + b * P1(word).

    The model is that of the triples with ``train``, or of ``whole`` where they are only a part; all distinct ones are looked up in its trie.
    """
    if not len(word):
        return np.zeros(0), np.zeros(0)
    grams = Grams(first, second, word, train)
    counts, kinds = whole(grams), len(grams.words)
    firsts = np.arange(len(grams.firsts))
    near = Order(firsts, len(firsts), grams.near_first, grams.near_word, counts.near, counts.near_totals, counts.near_times, kinds)
    q2, b2 = near.ask(firsts, grams.near_first, grams.near_word)
    del near
    universe = len(firsts) * len(grams.seconds)
    far = Order(grams.contexts, universe, grams.pair, grams.word, counts.far, counts.far_totals, counts.far_times, kinds)
    q3, b3 = far.ask(grams.contexts, grams.pair, grams.word)
    return (q3 + b3 * q2[grams.near])[grams.group], (b3 * b2[grams.near])[grams.group]


def _score_words(n: int, v: int):
    """Exact counts for tokens of words without a short number; rows of other kinds go through."""

    def run(key, counted, table):
        one = log_one(n, v)
        words = counted.column("words").combine_chunks().flatten().to_numpy().view(np.uint64)
        counts = counted.column("counts").combine_chunks().flatten().to_numpy()
        code, chunk, place, q, b = _tokens_read(table.column("tokens").drop_null().to_pylist())
        number = np.zeros(len(code), np.int64)
        if len(words):
            at = np.minimum(np.searchsorted(words, code), len(words) - 1)
            number = np.where(words[at] == code, counts[at], 0)
        chunks, chunk = np.unique(chunk, return_inverse=True)
        docs, group = np.unique((chunk.astype(np.uint64) << np.uint64(16)) | place, return_inverse=True)
        logs = np.log10(q + b * ((number + 1) / (n + v + 1)))
        score, known, base = (np.bincount(group, weights=w, minlength=len(docs)) for w in (logs, number > 0, _base(one, number)))
        cut = np.searchsorted(docs >> np.uint64(16), np.arange(len(chunks) + 1))
        passed = table.filter(table.column("chunk").is_valid())
        own = pa.table(
            {
                "chunk": pa.array(chunks, pa.int64()),
                "parts": pa.array(_parts(docs & np.uint64(0xFFFF), score, known, base, cut), pa.binary()),
                **{c: pa.nulls(len(chunks), table.column(c).type) for c in ("ids", *SUMS)},
            }
        )
        return pa.concat_tables([passed.select(own.column_names), own])

    return run


def _sum_chunk(key, table):
    """(doc_id, sums) of the documents of a chunk, from all shards that its triples and words went to."""
    values = {c: table.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", *SUMS)}
    place, *parts = _parts_read(table.column("parts").to_pylist())
    score, known, base = (np.bincount(place, weights=part, minlength=len(values["ids"])) for part in parts)
    return pa.table(
        {"doc_id": values["ids"], "n_tokens": values["n_tokens"], "n_known": values["n_known"] + known, "base": values["base"] + base, "score": score}
    )


def frequent_words(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(words, counts) of the most frequent words: all from that bin of counts on from which there are at most ``FREQUENT``."""
    bins = counted.select(F.explode(F.arrays_zip("bins", "kinds")).alias("t")).groupBy("t.bins").agg(F.sum("t.kinds").alias("kinds"))
    bins = bins.toPandas().sort_values("bins", ascending=False)  # some hundred bins
    held = bins["bins"][bins["kinds"].cumsum() <= FREQUENT]
    if not len(held):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    top = counted.select("words", "counts").mapInArrow(_frequent(int(held.min())), "word long, times long").toPandas()  # FREQUENT bounds it
    return top["word"].to_numpy(np.int64).view(np.uint64), top["times"].to_numpy(np.int64)


def _frequent_pairs(words: np.ndarray, numbers: np.ndarray, start: bool, rate: float):
    """Pairs of the given words, and of the start of a text if it counts, that are more than that share of the tokens seen at once."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, seen, held = [], [], 0, 0

        def out():
            found, sums = _merge(pairs, counts)
            many = sums > rate * seen
            return pa.RecordBatch.from_arrays([pa.array(found[many].view(np.int64)), pa.array(sums[many])], ["pair", "times"])

        for batch in source:
            for texts in B.chunks(batch.column("text"), SLICE_BYTES):
                found, offsets = tokens(texts)
                at = np.minimum(np.searchsorted(words, found), len(words) - 1)
                first = _before(np.where(words[at] == found, numbers[at], HASHED), offsets)
                second = _before(first, offsets)
                both = (first < HASHED) & (second < HASHED)
                if not start:
                    both &= (first != START) & (second != START)
                kinds, sums = np.unique(_pair(second[both], first[both]), return_counts=True)
                pairs.append(kinds)
                counts.append(sums)
                seen += len(found)
                held += len(kinds)
                if held > 4_000_000:
                    merged = _merge(pairs, counts)
                    pairs, counts, held = [merged[0]], [merged[1]], len(merged[0])
                    if held > 2_000_000:
                        yield out()
                        pairs, counts, seen, held = [], [], 0, 0
        if pairs:
            yield out()

    return run


def frequent_pairs(train: DataFrame, model: Frequent) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, counts) of the pairs of frequent words with more occurrences than the limit.

    Half the limit, as a share of the tokens, is what a task may leave out, so counts are below the true ones by half the limit at most.
    The pairs say only what is dealt to which shard.
    """
    held = model.wide(model.numbers)
    if not held.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    start = bool(model.wide(np.array([START]))[0])
    run = _frequent_pairs(model.words[held], model.numbers[held], start, model.limit / 2 / model.n)
    found = train.select("text").mapInArrow(run, "pair long, times long").groupBy("pair").agg(F.sum("times").alias("times"))
    found = found.filter(F.col("times") > model.limit // 2).toPandas()  # as many as half limits go into all tokens, at most
    return found["pair"].to_numpy(np.int64).view(np.uint64), found["times"].to_numpy(np.int64)


def scored(docs: DataFrame, held_out: str = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); texts that are not held out train the model."""
    spark = docs.sparkSession
    source = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~F.expr(held_out)).alias("train"))
    size = source.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(4, size // 16 // WORDS_PER_SHARD + 1)
    words = source.filter("train").select("text").mapInArrow(_count_words(buckets), "bucket long, words array<long>, counts array<long>")
    schema = "bucket long, words array<long>, counts array<long>, n long, v long, bins array<long>, kinds array<long>"
    counted = stage(words.groupBy("bucket").applyInArrow(_sum_words, schema), "word-counts")
    n, v = (x or 0 for x in counted.agg(F.sum("n"), F.sum("v")).head())
    frequent = Frequent(*frequent_words(counted), n, v)
    model = spark.sparkContext.broadcast(frequent.with_pairs(*frequent_pairs(source.filter("train"), frequent)))

    # A byte per word at least, and about six in fact: shards are cut for that.
    shards = size // 6 // PAIRS_PER_SHARD + 1
    merges = max(4, shards // SHARDS_PER_MERGE + 1)
    sums = "ids array<long>, " + ", ".join(f"{c} array<double>" for c in SUMS)
    # A chunk is named by the number of its first row, which depends on the partitions of the source only.
    source = source.withColumn("row", F.monotonically_increasing_id())
    triples = source.mapInArrow(_triples(shards, model), "bucket long, chunk long, data binary, " + sums)
    # Counts of what is dealt out are added up over all shards; both uses of the triples read one shuffle.
    shard = triples.groupBy("bucket")
    merged = "near binary, far binary, wide {0}, deep {0}, times array<long>"
    sent = shard.applyInArrow(_count_shard(model, merges), "bucket long, shard long, " + merged.format("array<long>"))
    merged = sent.groupBy("bucket").applyInArrow(_merge_counts, "bucket long, source long, " + merged.format("binary"))
    asked = shard.cogroup(merged.groupBy("bucket"))
    asked = asked.applyInArrow(_score_shard(model, buckets, merges), "bucket long, chunk long, parts binary, tokens binary, " + sums)
    exact = counted.select("bucket", "words", "counts").groupBy("bucket").cogroup(asked.groupBy("bucket"))
    exact = exact.applyInArrow(_score_words(n, v), "chunk long, parts binary, " + sums)
    total = exact.groupBy("chunk").applyInArrow(_sum_chunk, "doc_id long, n_tokens double, n_known double, base double, score double")
    total = total.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in (*SUMS, "score")])
    return total.select(
        "doc_id", F.expr(held_out).alias("held_out"), F.round("n_tokens").cast("long").alias("n_tokens"), F.round("n_known").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )

"""Removal of repeated passages: every byte covered by a ``span``-byte string that starts in an earlier document too.

A full external suffix sort writes several 64-bit words for every byte of text. Here suffixes are sampled and
the others induced from them, as induced sorting does, with order and common prefix cut at ``span`` bytes:

1. Sampled suffixes are the local minima of a hash over ``NAME`` bytes, so every ``span``-byte string holds one at the
   same place wherever it occurs. Their short names are sorted by range; names of one document only are dropped.
2. The samples left are named by their whole surroundings (every ``span``-byte string around the name). All but the
   earliest document of equal surroundings repeat an earlier one there.
3. The earliest documents of different surroundings around one name are compared by the lengths to the left and right
   that they share with each other: all strings of ``span`` bytes around the name, induced from the sample.
4. The covered bytes of a document are merged and cut out.

Whole copies of a text are settled by its digest first. Texts are UTF-8 bytes, a null is empty; matches never cross
documents; all is judged on the input. A null ``doc_id`` has no row in the report and is left as it is; rows of one ``doc_id`` never match each
other: with equal texts they are one document, with different texts each is cut on its own, whatever the layout. Names and
surroundings are compared by 64-bit hashes. Extra columns are ignored. Every step is a shuffle by name or document; nothing is gathered per text but its own spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import batches as B
from seriesmill.llm.packing import packed, unpacked
from seriesmill.operators.order import with_position
from seriesmill.session import lookup, stage

SPAN = 50
#: Bytes of a sample's name.
NAME = 20
SAMPLES_PER_BUCKET = 250_000
#: Text that is hashed at once; it takes some 60 times as much memory.
SLICE_BYTES = 1 << 20
NO_NAME = np.uint64(0xFFFFFFFFFFFFFFFF)


def _slide(values: np.ndarray, width: int, pick, fill) -> np.ndarray:
    """pick over values[i : i + width] for every i (beyond the end: fill)."""
    out, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        moved = np.full_like(out, fill)
        moved[: len(out) - step] = out[step:]
        out, reach = pick(out, moved), reach + step
    return out


def samples(texts: B.Texts, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, place in the chunk) of the sampled suffixes of every text of at least ``span`` bytes."""
    size = len(texts.data)
    if size < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    names = _names(texts.data)
    starts, ends = texts.offsets[:-1], texts.offsets[1:]
    closed = np.zeros(size + 1, np.int32)
    np.add.at(closed, np.maximum(ends - NAME + 1, starts), 1)
    np.add.at(closed, ends, -1)
    names[np.cumsum(closed[:-1]) > 0] = NO_NAME
    width = span - NAME + 1
    least = _slide(names, width, np.minimum, NO_NAME)
    closed[:] = 0
    np.add.at(closed, np.maximum(ends - span + 1, starts), 1)
    np.add.at(closed, ends, -1)
    least[np.cumsum(closed[:-1]) > 0] = 0
    seen = _slide(least[::-1], width, np.maximum, np.uint64(0))[::-1]
    places = np.flatnonzero((names == seen) & (names != NO_NAME))
    return names[places], places


def _names(data: np.ndarray) -> np.ndarray:
    """Hash of the NAME bytes at every place (the last ones are filled up)."""
    sums = B.prefix_hashes(data)
    inverse = B.powers(pow(B.BASE, -1, 1 << 64), len(data))
    names = np.full(len(data), NO_NAME)
    count = max(0, len(data) - NAME + 1)
    names[:count] = (sums[NAME:] - sums[:count]) * inverse[:count]
    names[:count] ^= names[:count] >> np.uint64(31)
    names[:count] *= B.GOLDEN
    names[:count] ^= names[:count] >> np.uint64(29)
    return names


def _named(span: int, buckets: int):
    """Rows (bucket, names, documents, places) of a chunk. A name keeps 32 bits beside its bucket: enough to find candidates."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids = batch.column("doc_id").to_numpy()
            for texts in B.chunks(batch.column("text"), SLICE_BYTES):
                names, places = samples(texts, span)
                if not len(names):
                    continue
                row = np.searchsorted(texts.offsets, places, "right") - 1
                places = (places - texts.offsets[row]).astype(np.int32)
                doc = ids[texts.first : texts.last][row]
                order, limits = B.cut_by_bucket(B.mix(names), buckets)
                held = np.flatnonzero(np.diff(limits))
                offsets = np.concatenate(([0], limits[1:][held]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(held.astype(np.int64)),
                        B.lists((names[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32), offsets),
                        B.lists(doc[order], offsets),
                        B.lists(places[order], offsets),
                    ],
                    ["bucket", "names", "docs", "places"],
                )

    return run


def _flat(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(name).combine_chunks().flatten().to_numpy() for name in names]


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and group number of equal neighbours."""
    fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
    return np.flatnonzero(fresh), np.cumsum(fresh) - 1


def _by_doc(docs: np.ndarray, **lists: np.ndarray) -> pa.Table:
    order = np.argsort(docs, kind="stable")
    first, _ = _groups(docs[order]) if len(docs) else (np.zeros(0, np.int64), None)
    offsets = np.append(first, len(docs))
    columns = {"doc_id": pa.array(docs[order][first])}
    return pa.table(columns | {name: B.lists(values[order], offsets) for name, values in lists.items()})


def _shared_names(parts: int):
    def run(key, table):
        names, docs, places = _flat(table, "names", "docs", "places")
        order = np.argsort(names, kind="stable")
        names, docs, places = names[order], docs[order], places[order]
        first, group = _groups(names)
        own = docs // parts
        shared = (np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first))[group]
        return _by_doc(docs[shared], places=places[shared])

    return run


def _samples_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Chunks of a batch with the rows and chunk places of the samples listed in ``places``."""
    lists = batch.column("places")
    counts = np.diff(lists.offsets.to_numpy())
    values, begin = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(counts)))
    for texts in B.chunks(batch.column("text"), SLICE_BYTES):
        row = np.repeat(np.arange(texts.last - texts.first), counts[texts.first : texts.last])
        local = values[begin[texts.first] : begin[texts.last]].astype(np.int64)
        yield texts, row, local, texts.offsets[row] + local


def _surroundings(span: int, buckets: int):
    """Rows (bucket, names, surroundings, documents, places) of the candidates of a chunk."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids = batch.column("doc_id").to_numpy()
            for texts, row, local, places in _samples_of(batch):
                if not len(row):
                    continue
                sums = B.prefix_hashes(texts.data)
                names = B.range_hashes(sums, places, places + NAME)
                low = np.maximum(places - (span - NAME), texts.offsets[row])
                high = np.minimum(places + span, texts.offsets[row + 1])
                around = B.mix(B.range_hashes(sums, low, high) + (places - low).astype(np.uint64) * B.GOLDEN)
                order, limits = B.cut_by_bucket(names, buckets)
                held = np.flatnonzero(np.diff(limits))
                offsets = np.concatenate(([0], limits[1:][held]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(held.astype(np.int64)),
                        B.lists(names[order].view(np.int64), offsets),
                        B.lists(around[order].view(np.int64), offsets),
                        B.lists(ids[texts.first : texts.last][row][order], offsets),
                        B.lists(local[order].astype(np.int32), offsets),
                    ],
                    ["bucket", "names", "around", "docs", "places"],
                )

    return run


def _settled(parts: int):
    def run(key, table):
        """Samples whose whole surroundings repeat an earlier document, and those left to compare (open)."""
        names, around, docs, places = _flat(table, "names", "around", "docs", "places")
        order = np.lexsort((docs, around, names))
        names, around, docs, places = names[order], around[order], docs[order], places[order]
        name_first, name_group = _groups(names)
        fresh = np.concatenate(([True], (names[1:] != names[:-1]) | (around[1:] != around[:-1])))
        first, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        later = docs // parts > (docs // parts)[first][group]
        several = (np.add.reduceat(fresh.astype(np.int64), name_first) > 1)[name_group]
        # One bearer of the surroundings is enough to compare, but each place of the earliest document is cut.
        keep = later | (several & ~later)
        return _by_doc(docs[keep], places=places[keep], settled=later[keep])

    return run


def _contexts(span: int, buckets: int):
    """Rows (bucket, names, documents, places, left, bytes) around the open samples of a chunk."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids = batch.column("doc_id").to_numpy()
            for texts, row, local, places in _samples_of(batch):
                if not len(row):
                    continue
                names = B.range_hashes(B.prefix_hashes(texts.data), places, places + NAME)
                low = np.maximum(places - (span - NAME), texts.offsets[row])
                high = np.minimum(places + span, texts.offsets[row + 1])
                order, limits = B.cut_by_bucket(names, buckets)
                held = np.flatnonzero(np.diff(limits))
                offsets = np.concatenate(([0], limits[1:][held]))
                low, high, at = low[order], high[order], places[order]
                ends = np.cumsum(high - low)
                spread = np.repeat(low - np.concatenate(([0], ends[:-1])), high - low) + np.arange(ends[-1])
                cuts = np.concatenate(([0], ends))[offsets]
                raw = texts.data[spread]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(held.astype(np.int64)),
                        B.lists(names[order].view(np.int64), offsets),
                        B.lists(ids[texts.first : texts.last][row][order], offsets),
                        B.lists(local[order].astype(np.int32), offsets),
                        B.lists((at - low).astype(np.int32), offsets),
                        B.lists((high - low).astype(np.int32), offsets),
                        pa.array([raw[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    ],
                    ["bucket", "names", "docs", "places", "left", "sizes", "raw"],
                )

    return run


def _induced(span: int, parts: int):
    def run(key, table):
        """Strings of ``span`` bytes around equal names that an earlier document holds too."""
        names, docs, places, left, sizes = _flat(table, "names", "docs", "places", "left", "sizes")
        data = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("raw").to_pylist()])
        ends = np.cumsum(sizes.astype(np.int64))
        begins = ends - sizes
        sums, at = B.prefix_hashes(data), begins + left
        found_docs, found_from = [], []
        for before in range(span - NAME + 1):
            use = np.flatnonzero((left >= before) & (at - before + span <= ends))
            if not len(use):
                continue
            start = at[use] - before
            keys = B.mix(B.range_hashes(sums, start, start + span) ^ names[use].view(np.uint64))
            order = np.argsort(keys)
            keys, use = keys[order], use[order]
            first, group = _groups(keys)
            own = docs[use] // parts
            later = own > np.minimum.reduceat(own, first)[group]
            found_docs.append(docs[use][later])
            found_from.append(places[use][later] - np.int32(before))
        if not found_docs:
            return _by_doc(np.zeros(0, np.int64), starts=np.zeros(0, np.int32))
        return _by_doc(np.concatenate(found_docs), starts=np.concatenate(found_from).astype(np.int32))

    return run


def _cut(span: int, whole_characters: bool):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The spans of each document and the bytes that stay."""
        for batch in source:
            out = {"doc_id": [], "starts": [], "ends": [], "kept": []}
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("settled"), batch.column("starts"))
            for doc, text, settled, starts in rows:
                raw = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                step = np.zeros(len(raw) + 1, np.int64)
                if settled.is_valid:
                    at = settled.values.to_numpy().astype(np.int64)
                    # All strings around the name, where the document is long enough for one.
                    np.add.at(step, np.maximum(at - (span - NAME), 0), 1)
                    np.add.at(step, np.minimum(at + span, len(raw)), -1)
                if starts.is_valid:
                    at = starts.values.to_numpy().astype(np.int64)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + span, -1)
                covered = np.concatenate(([False], np.cumsum(step[:-1]) > 0, [False]))
                edges = np.flatnonzero(covered[1:] != covered[:-1])
                out["doc_id"].append(doc)
                out["starts"].append(edges[::2])
                out["ends"].append(edges[1::2])
                kept = raw[~covered[1:-1]].tobytes()
                out["kept"].append(kept.decode("utf-8", "ignore").encode() if whole_characters else kept)
            kinds = {"doc_id": pa.int64(), "starts": pa.list_(pa.int64()), "ends": pa.list_(pa.int64()), "kept": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(out[c], kinds[c]) for c in out], list(out))

    return run


def repeated_spans(docs: DataFrame, span: int = SPAN, whole_characters: bool = False) -> tuple[DataFrame, DataFrame]:
    """(texts, cuts): texts has key, doc_id, n_bytes, digest and ``copy`` (an earlier document has the same whole text);
    cuts has key, starts, ends (removed spans) and kept (bytes left) of the documents, other than those
    copies, that lose something; ``whole_characters`` drops the rest of torn characters too. A copy shorter than
    ``span`` holds no such string and loses nothing. The key stands for doc_id and text."""
    source = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    digests = source.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("digest"))
    digests = stage(digests, "text-digests")
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    texts = stage(digests.join(first, "digest").withColumn("copy", F.col("doc_id") > F.col("first_id")), "texts")
    total = texts.filter("NOT copy").agg(F.sum("n_bytes")).head()[0] or 0
    texts, parts, repeated = _keyed(texts)
    if parts == 1:
        copies = texts.filter("copy").select("doc_id").distinct()
        own = source.join(lookup(copies), "doc_id", "left_anti")
    else:
        keys = texts.filter("NOT copy").select("doc_id", "digest", "key").distinct()
        own = source.withColumn("digest", F.sha2("text", 256)).join(keys, ["doc_id", "digest"]).select(F.col("key").alias("doc_id"), "text")
    if repeated:
        own = own.dropDuplicates(["doc_id"])
    buckets = max(8, total // (16 * SAMPLES_PER_BUCKET) + 1)

    named = own.mapInArrow(_named(span, buckets), "bucket long, names array<int>, docs array<long>, places array<int>")
    shared = named.groupBy("bucket").applyInArrow(_shared_names(parts), "doc_id long, places array<int>")
    flagged = stage(_per_doc(shared, "places"), "shared-names")
    around = _with_text(own, flagged).mapInArrow(
        _surroundings(span, buckets), "bucket long, names array<long>, around array<long>, docs array<long>, places array<int>"
    )
    settled = around.groupBy("bucket").applyInArrow(_settled(parts), "doc_id long, places array<int>, settled array<boolean>")
    settled = stage(settled, "settled-names")
    pairs = F.arrays_zip("places", "settled")
    pick = lambda wanted: F.transform(F.filter(pairs, lambda x: x["settled"] == wanted), lambda x: x["places"])
    cut_whole = _per_doc(settled.select("doc_id", pick(True).alias("settled")).filter(F.size("settled") > 0), "settled")
    to_compare = _per_doc(settled.select("doc_id", pick(False).alias("places")).filter(F.size("places") > 0), "places")
    contexts = _with_text(own, stage(to_compare, "open-names")).mapInArrow(
        _contexts(span, buckets),
        "bucket long, names array<long>, docs array<long>, places array<int>, left array<int>, sizes array<int>, raw binary",
    )
    induced = contexts.groupBy("bucket").applyInArrow(_induced(span, parts), "doc_id long, starts array<int>")
    spans = stage(cut_whole.join(_per_doc(induced, "starts"), "doc_id", "full"), "repeated-spans")
    cuts = _with_text(own, spans).mapInArrow(_cut(span, whole_characters), "doc_id long, starts array<long>, ends array<long>, kept binary")
    return texts, cuts.withColumnRenamed("doc_id", "key")


def _keyed(texts: DataFrame) -> tuple[DataFrame, int, bool]:
    """The texts with ``key``, by what the key is divided for the rank of the doc_id, and whether any doc_id stands twice.

    It is the doc_id itself unless one stands with different texts; then a key is a rank of the doc_id and a number of its text.
    """
    ids = texts.groupBy("doc_id").agg((F.min("digest") != F.max("digest")).alias("several"), (F.count("*") > 1).alias("again"))
    several, again = ids.agg(F.max("several"), F.max("again")).head()
    if not several:
        return texts.withColumn("key", F.col("doc_id")), 1, bool(again)
    placed = with_position(texts.select("doc_id", "digest").distinct(), ["doc_id", "digest"], "place")
    first = placed.groupBy("doc_id").agg(F.min("place").alias("first"))
    numbered = stage(placed.join(first, "doc_id"), "texts-of-ids")
    parts = numbered.agg(F.max(F.expr("place - first"))).head()[0] + 1
    keys = numbered.select("doc_id", "digest", F.expr(f"first * {parts}L + place - first").alias("key"))
    return stage(texts.join(keys, ["doc_id", "digest"]), "texts"), parts, True


def _per_doc(lists: DataFrame, name: str) -> DataFrame:
    """Join the lists of a document; they are parts of its own text, so its length bounds them."""
    return lists.groupBy("doc_id").agg(F.flatten(F.collect_list(name)).alias(name))


def _with_text(own: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows with their texts. Texts that are not asked for are left out before the shuffle if the list is short."""
    wanted = own.join(lookup(rows.select(F.col("doc_id"))), "doc_id", "left_semi")
    return wanted.join(rows, "doc_id")


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """The documents with ``text`` less its repeated bytes and ``n_chars`` counted anew; emptied ones go.

    A character that loses some of its bytes goes whole. Texts that were null or empty before stay as they were.
    """
    texts, cuts = repeated_spans(docs, span, whole_characters=True)
    named = texts.select("key", F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "copy", "n_bytes").distinct()
    changed = named.filter("NOT copy").join(cuts.select("key", F.col("kept").cast("string").alias("_rest")), "key")
    gone = named.filter(f"copy AND n_bytes >= {span}").withColumn("_rest", F.lit(""))
    found = stage(changed.unionByName(gone, allowMissingColumns=True).select("_id", "_digest", "_rest"), "cut-texts")
    needed = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
    same = (F.col("doc_id").cast("long") == F.col("_id")) & (F.sha2(F.coalesce("text", F.lit("")), 256) == F.col("_digest"))
    joined = packed(docs, *needed).join(found, same, "left").filter("_rest IS NULL OR _rest <> ''")
    out = joined.withColumn("text", F.coalesce("_rest", "text"))
    if "n_chars" in needed:
        out = out.withColumn("n_chars", F.when(F.col("_rest").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return unpacked(out, docs.columns, needed)


def report(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    texts, cuts = repeated_spans(docs, span)
    lost = stage(
        cuts.select(
            "key",
            F.octet_length("kept").cast("long").alias("n_kept"),
            F.size("starts").cast("long").alias("spans"),
            F.sha2("kept", 256).alias("kept_digest"),
        ),
        "cuts",
    )
    copied = F.col("copy") & (F.col("n_bytes") >= span)
    nothing = F.sha2(F.lit(""), 256)
    return texts.join(lost, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce(F.expr("n_bytes - n_kept"), F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, nothing).otherwise(F.coalesce("kept_digest", "digest")).alias("kept_sha256"),
    )

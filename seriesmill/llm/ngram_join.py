"""N-gram Jaccard join: a blocked sparse product of the document by shingle incidence.

Rows of the incidence matrix are the different shingle sets (copies share one row). A block of the product
holds a range of shingle hashes. Only the columns are multiplied that a pair above the threshold cannot avoid:
in one order of all shingles (rare ones first, by a counting sketch over all documents) two sets of a
Jaccard similarity of at least t share one of the first ``n - ceil(t n) + 1`` shingles of each. Entries carry
their place, and how many of the entries before it lie in columns that are shared at all: with the size these bound the
overlap, and pairs below the bound are discarded. For pairs left the overlap is accumulated over all columns and the
threshold tested in integers.

A crowded column is not multiplied out at once: its rows are first compared with a pivot, the row with the
fewest rarer shingles of its own; what links is one class, and further pivots follow while classes merge. The
product then takes only columns that more than one class shares, and multiplies the rows outside a column's largest class
with all rows; in a crowded column only with those whose sizes the entry still allows, found by bands of size. A
row that has many shingles of its own, as the outer ones of a large group of near copies, so meets no rows of its own size.
Classes and verified links therefore are those of the whole product.

Nulls and texts without words have an empty set and link with nothing. Equal documents get equal rows. A null
``doc_id`` is dropped; rows that repeat a ``doc_id`` with its text stand or go together. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm import batches as B
from seriesmill.llm.components import components
from seriesmill.llm.packing import packed, unpacked
from seriesmill.session import lookup, stage

SIZE = 5
PERCENT = 80
#: Counters of the sketch that orders shingles by rarity: 2 ** 22, whatever the input. Any order gives the same
#: result; the sketch decides only how many rows meet in a column.
SKETCH_BITS = 22
SLICE = 1 << 16
ENTRIES_PER_BUCKET = 1_000_000
#: Shingles are compared by hashes of so many bits; the rest of a word holds the text's place in its chunk.
HASH_BITS = np.uint64(50)
#: Columns of more rows get pivots before the product, in so many rounds at most (whatever is left, the product compares).
CROWDED = 32
PIVOT_ROUNDS = 6
#: Bands of set sizes for each doubling of the size.
BANDS = 32


def sets_of(texts: B.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles, sorted by text, then hash."""
    text, hashes = B.shingles(B.words(texts), size)
    keys = np.sort((text.astype(np.uint64) << HASH_BITS) | (hashes >> (np.uint64(64) - HASH_BITS)))
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    return (keys >> HASH_BITS).astype(np.int64), keys & ((np.uint64(1) << HASH_BITS) - np.uint64(1))


def fingerprints(text: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each set and one 64-bit value that depends on nothing but the set."""
    sizes = np.bincount(text, minlength=rows)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(B.mix(hashes * B.GOLDEN + B.GOLDEN), out=sums[1:])
    ends = np.cumsum(sizes)
    return sizes, B.mix((sums[ends] - sums[ends - sizes]) + sizes.astype(np.uint64) * B.GOLDEN)


def _describe(size: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in source:
            for texts in B.chunks(batch.column("text")):
                text, hashes = sets_of(texts, size)
                counters += np.bincount(sketch_cell(hashes), minlength=len(counters))
                sizes, marks = fingerprints(text, hashes, texts.last - texts.first)
                ids = batch.column("doc_id").slice(texts.first, len(sizes))
                nulls = pa.nulls(len(sizes), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes), B.as_long(marks), nulls, pa.nulls(len(sizes), pa.binary())],
                    ["doc_id", "n_shingles", "mark", "slice", "counts"],
                )
        if counters.any():
            parts = np.minimum(counters, 0xFFFFFFFF).astype(np.uint32).reshape(-1, SLICE)
            counts = pa.array([pa.compress(x.tobytes(), "zstd", asbytes=True) for x in parts], pa.binary())
            nulls = pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [nulls, nulls, nulls, pa.array(np.arange(len(parts))), counts], ["doc_id", "n_shingles", "mark", "slice", "counts"]
            )

    return run


def sketch_cell(hashes: np.ndarray) -> np.ndarray:
    return (B.mix(hashes) & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _add_counts(key, table):
    total = np.zeros(SLICE, np.int64)
    for part in table.column("counts").to_pylist():
        total += np.frombuffer(pa.decompress(part, 4 * SLICE, "zstd"), np.uint32)
    # Cells hold many rare shingles each; what counts is how far a cell stands out of that noise.
    mean = total.mean()
    classes = np.minimum(4 * np.log2(1 + np.maximum(0, total - mean) / np.sqrt(mean + 1)), 63).astype(np.uint8)
    return pa.table({"slice": pa.array([key[0].as_py()]), "classes": pa.array([classes.tobytes()], pa.binary())})


def describe(docs: DataFrame, size: int = SIZE) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n_shingles, mark) of every document, and the rarity classes of the sketch (a fixed 4 MB)."""
    schema = "doc_id long, n_shingles long, mark long, slice long, counts binary"
    source = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    both = stage(source.mapInArrow(_describe(size), schema), "shingle-sets")
    sketch = both.filter("slice IS NOT NULL").groupBy("slice").applyInArrow(_add_counts, "slice long, classes binary")
    classes = np.zeros(1 << SKETCH_BITS, np.uint8)
    for row in sketch.collect():  # SKETCH_BITS bounds it
        classes[row["slice"] * SLICE :][:SLICE] = np.frombuffer(row["classes"], np.uint8)
    return both.filter("slice IS NULL").select("doc_id", "n_shingles", "mark"), classes


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many of its first shingles a set must offer: n - ceil(t n) + 1."""
    return sizes - (percent * sizes + 99) // 100 + 1


def _entries(size: int, percent: int, buckets: int, classes):
    """Rows (bucket, and for its entries: shingle, set, set size, place) of one chunk of documents."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for texts in B.chunks(batch.column("text"), B.CHUNK_BYTES // 2):
                rows = texts.last - texts.first
                text, hashes = sets_of(texts, size)
                if not len(text):
                    continue
                sizes, marks = fingerprints(text, hashes, rows)
                rare = np.frombuffer(classes.value, np.uint8)[sketch_cell(hashes)].astype(np.uint64)
                ranked = (text.astype(np.uint64) << np.uint64(52)) | (rare << np.uint64(46)) | (hashes >> np.uint64(4))
                order = np.argsort(ranked)  # keeps texts together: they lead the key
                place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                use = place < np.repeat(needed(sizes, percent), sizes)
                text, place, hashes = text[use], place[use], hashes[order][use]
                order, limits = B.cut_by_bucket(B.mix(hashes), buckets)
                counts = np.diff(limits)
                held = np.flatnonzero(counts)
                offsets = np.concatenate(([0], limits[1:][held]))
                text = text[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(held.astype(np.int64)),
                        B.lists(hashes[order].view(np.int64), offsets),
                        B.lists(marks[text].view(np.int64), offsets),
                        B.lists(sizes[text].astype(np.int32), offsets),
                        B.lists(place[order].astype(np.int32), offsets),
                    ],
                    ["bucket", "shingle", "mark", "n", "place"],
                )

    return run


def _columns(key, table):
    """Entries of the columns of a block that at least two different sets share."""
    flat = {c: table.column(c).combine_chunks().flatten().to_numpy() for c in ("shingle", "mark", "n", "place")}
    order = np.lexsort((flat["mark"], flat["shingle"]))
    flat = {c: v[order] for c, v in flat.items()}
    same = flat["shingle"][1:] == flat["shingle"][:-1]
    fresh = np.concatenate(([True], ~(same & (flat["mark"][1:] == flat["mark"][:-1]))))
    flat = {c: v[fresh] for c, v in flat.items()}
    same = flat["shingle"][1:] == flat["shingle"][:-1]
    shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
    return pa.table({c: v[shared] for c, v in flat.items()})


def _counted(columns: DataFrame) -> DataFrame:
    """The entries with ``before``: how many entries of the same row come earlier in these columns."""
    return columns.withColumn("before", F.row_number().over(Window.partitionBy("mark").orderBy("place")) - 1)


def _possible(percent: int):
    """Bound of the overlap that two entries of a column still allow, in integers.

    Before the column at most the smaller number of shared entries is common, after it the smaller rest.
    """
    most = F.least("before_a", "before_b") + F.least(F.expr("n_a - place_a"), F.expr("n_b - place_b"))
    return (F.lit(100 + percent) * most >= F.lit(percent) * (F.col("n_a") + F.col("n_b"))) & (
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their exact overlap, and whether they link."""
    left = sets.select(F.col("mark").alias("a"), F.col("hashes").alias("hashes_a"))
    right = sets.select(F.col("mark").alias("b"), F.col("hashes").alias("hashes_b"))
    overlap = F.size(F.array_intersect("hashes_a", "hashes_b"))
    union = F.size("hashes_a") + F.size("hashes_b") - F.col("overlap")
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", "hashes_a", "hashes_b", overlap.alias("overlap"))
        .select("a", "b", "overlap", (100 * F.col("overlap") >= percent * union).alias("linked"))
    )


def _full_sets(size: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for texts in B.chunks(batch.column("text")):
                text, hashes = sets_of(texts, size)
                sizes = np.bincount(text, minlength=texts.last - texts.first)
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                marks = batch.column("mark").slice(texts.first, len(sizes))
                yield pa.RecordBatch.from_arrays([marks, B.lists(hashes.view(np.int64), offsets)], ["mark", "hashes"])

    return run


def _sets_for(docs: DataFrame, members: DataFrame, marks: DataFrame, size: int) -> DataFrame:
    """(mark, hashes) of the named sets, from one text each."""
    bearers = members.join(marks.distinct(), "mark", "left_semi").groupBy("mark").agg(F.min("doc_id").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(lookup(bearers), "doc_id")
    return stage(texts.select("mark", "text").mapInArrow(_full_sets(size), "mark long, hashes array<long>"), "full-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("mark")).unionByName(pairs.select(F.col("b").alias("mark")))


def _labelled(columns: DataFrame, links: DataFrame | None) -> DataFrame:
    """Entries with the class of their row, in columns that more than one class shares.

    ``held`` is the number of entries of the column, ``major`` the class with most of them.
    """
    if links is None:
        labelled = columns.withColumn("label", F.col("mark"))
    else:
        labels = stage(components(links), "labels")
        labelled = columns.join(labels, columns.mark == labels.node, "left").select(
            *columns.columns, F.coalesce("component", "mark").alias("label")
        )
    classes = labelled.groupBy("shingle", "label").agg(F.count("*").alias("of_class")).groupBy("shingle")
    classes = classes.agg(
        F.sum("of_class").alias("held"), F.max(F.struct("of_class", "label"))["label"].alias("major"), F.count("*").alias("classes")
    )
    return labelled.join(classes.filter("classes > 1").drop("classes"), "shingle")


ENTRY = ("mark", "n", "place", "before", "label")


def _with_pivots(columns: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of each row with the pivot of its column; a later turn takes another pivot among the plainest rows."""
    plain = F.col("place") if turn == 0 else F.floor(F.expr("4 * place / n"))
    rank = F.struct(plain, F.xxhash64("mark", F.lit(turn)), F.col("mark"))
    pivot = columns.groupBy("shingle").agg(F.min_by(F.struct(*ENTRY), rank).alias("pivot"))
    left = pivot.select("shingle", *[F.col(f"pivot.{c}").alias(f"{c}_a") for c in ENTRY])
    both = left.join(columns.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ENTRY]), "shingle")
    both = both.filter("label_a <> label_b").filter(_possible(percent))
    return both.select(F.least("mark_a", "mark_b").alias("a"), F.greatest("mark_a", "mark_b").alias("b")).distinct()


def _product(columns: DataFrame, percent: int) -> DataFrame:
    """Overlap of the needed columns for every two rows of different classes, less what the bounds exclude.

    An entry allows partners of ``low`` to ``high`` shingles; one that allows none is left out. Of two rows of different
    classes one at least is outside the column's largest class. What two sets share outside these columns lies beyond
    the needed part of one of them, so the larger rest bounds it.
    """
    band = lambda n: F.floor(F.log2(n.cast("double")) * BANDS).cast("int")
    crowded = F.col("held") > CROWDED
    low = F.ceil(F.col("n") * percent / 100)
    high = F.floor(((100 + percent) * F.expr("before + n - place") - percent * F.col("n")) / percent)
    able = columns.withColumns({"low": low, "high": high}).filter("low <= high")
    bands = F.when(crowded, F.sequence(band(F.col("low")), band(F.col("high")))).otherwise(F.array(F.lit(-1)))
    sides = (*ENTRY, "low", "high")
    left = able.filter("label <> major").select("shingle", F.explode(bands).alias("band"), *[F.col(c).alias(f"{c}_a") for c in sides])
    own_band = F.when(crowded, band(F.col("n"))).otherwise(-1).alias("band")
    right = able.select("shingle", own_band, (F.col("label") == F.col("major")).alias("in_major"), *[F.col(c).alias(f"{c}_b") for c in sides])
    both = left.join(right, ["shingle", "band"]).filter("label_a <> label_b AND (in_major OR mark_a < mark_b)")
    both = both.filter("n_b BETWEEN low_a AND high_a AND n_a BETWEEN low_b AND high_b").filter(_possible(percent))
    rest = F.greatest(*[F.ceil(F.col(f"n_{x}") * percent / 100) - 1 for x in "ab"])
    ends = [F.least("mark_a", "mark_b").alias("a"), F.greatest("mark_a", "mark_b").alias("b")]
    counted = both.groupBy(*ends, F.expr("n_a + n_b").alias("total"), rest.alias("rest")).agg(F.count("*").alias("shared"))
    return counted.filter(F.lit(100 + percent) * F.expr("shared + rest") >= F.lit(percent) * F.col("total")).select("a", "b")


def similar_sets(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The documents with their sets (doc_id, n_shingles, mark) and verified links between sets.

    Links have columns a, b (marks), overlap; any two sets that reach the threshold are connected by them.
    """
    spark = docs.sparkSession
    members, classes = describe(docs, size)
    total = members.agg(F.sum("n_shingles")).head()[0] or 0
    buckets = max(8, total * (100 - percent) // 100 // ENTRIES_PER_BUCKET + 1)
    shared = spark.sparkContext.broadcast(classes.tobytes())
    schema = "bucket long, shingle array<long>, mark array<long>, n array<int>, place array<int>"
    source = docs.filter("doc_id IS NOT NULL").select("text")
    entries = source.mapInArrow(_entries(size, percent, buckets, shared), schema)
    columns = entries.groupBy("bucket").applyInArrow(_columns, "shingle long, mark long, n int, place int")
    columns = stage(_counted(columns), "shared-columns")

    crowds = columns.groupBy("shingle").count().filter(F.col("count") > CROWDED).select("shingle")
    crowded = stage(columns.join(crowds, "shingle", "left_semi"), "crowded-columns")
    links, sets = None, None
    for turn in range(PIVOT_ROUNDS):
        open_columns = stage(_labelled(crowded, links), "open-columns")
        held = open_columns.groupBy("shingle", "label").count().groupBy("shingle")
        held = held.agg(F.sum("count").alias("rows"), F.sum(F.col("count") * F.col("count")).alias("inside"))
        work = held.agg(F.sum(F.expr("rows * rows - inside")).alias("pairs"), F.sum("rows").alias("rows")).head()
        if (work["pairs"] or 0) <= CROWDED * (work["rows"] or 0):
            break
        pairs = stage(_with_pivots(open_columns, turn, percent), "pivot-pairs")
        sets = sets or _sets_for(docs, members, crowded.select("mark"), size)
        fresh = stage(_verified(pairs, sets, percent), "verified").filter("linked").select("a", "b", "overlap")
        links = fresh if links is None else links.unionByName(fresh)
        if not fresh.head(1):
            break
    open_columns = stage(_counted(_labelled(columns.drop("before"), links)), "open-columns")
    pairs = stage(_product(open_columns, percent), "pairs")
    fresh = stage(_verified(pairs, _sets_for(docs, members, _ends(pairs), size), percent), "verified")
    fresh = fresh.filter("linked").select("a", "b", "overlap")
    return members, fresh if links is None else links.unionByName(fresh)


def near_classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents linked, directly or through others, have one component_id.

    It is the smallest doc_id of the class; a document without words is its own class.
    """
    members, links = similar_sets(docs, size, percent)
    labels = components(links).withColumnsRenamed({"node": "mark"})
    marked = members.filter("n_shingles > 0").join(labels, "mark", "left")
    marked = stage(marked.select("doc_id", "n_shingles", F.coalesce("component", "mark").alias("class")), "classes")
    first = marked.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    alone = members.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return marked.join(first, "class").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents that are the first of their class, with their columns as they were."""
    kept = near_classes(docs, size, percent).filter("doc_id = component_id").select(F.col("doc_id").alias("kept_id"))
    shown = packed(docs, "doc_id")
    kept = shown.join(stage(kept, "kept"), F.col("doc_id") == F.col("kept_id"), "left_semi")
    return unpacked(kept, docs.columns, ("doc_id",))

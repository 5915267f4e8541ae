"""Near copies among embeddings: spherical k-means cells, blocked cosine products within cells, one kept of each group.

Centres are fitted on a bounded sample of vectors. Every vector goes to the cell of its nearest centre, and visits each cell of a lower number
that can hold a neighbour: across the plane between two centres, a neighbour at cosine c lies within the sine of its angle. So no link is
lost at any margin of that size (``margin``, exact by default). A cell is compared with itself and its visitors in blocks of at most ``BLOCK`` vectors;
a product returns one row per vector (links, by number of copies) and links that connect its groups, never its pairs.

Only vectors of the same label are compared; equal vectors are one, with a count. Null labels, and vectors that are null, zero or hold
null or non-finite components, link with nothing and stand for themselves; so do vectors of another length. Extra columns are
ignored. A null vec_id is dropped; rows that repeat a vec_id count as copies of one another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import batches as B
from seriesmill.llm.components import components
from seriesmill.session import stage

COSINE = 0.93
#: Vectors (in expectation) that centres are fitted on, and the most centres.
SAMPLE, CENTRES = 8192, 256
PER_CELL = 2048
BLOCK = 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that neither tiny nor huge components are lost."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def spherical_k_means(vectors: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    random = np.random.default_rng(0)
    centres = vectors[random.choice(len(vectors), min(count, len(vectors)), replace=False)]
    for _ in range(rounds):
        near = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, vectors)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _to_cells(centres: dict[int, np.ndarray], margin: float):
    def run(source):
        """Each vector in its cell, and as a visitor in cells of lower number within the margin."""
        for batch in source:
            if not batch.num_rows:
                continue
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                rows = np.flatnonzero(widths == width)
                part = batch.take(pa.array(rows))
                mine = unit(_matrix(part.column("vector")))
                own = centres[int(width)]
                score = mine @ own.T
                cell = score.argmax(axis=1)
                apart = np.sqrt(np.maximum(2 - 2 * (own @ own.T), 1e-18))
                visit = (score[np.arange(len(rows)), cell][:, None] - score) / apart[cell] <= margin
                visit &= np.arange(len(own))[None, :] < cell[:, None]
                row, to = np.nonzero(visit)
                every = np.concatenate((np.arange(len(rows)), row))
                taken = part.take(pa.array(every))
                yield pa.RecordBatch.from_arrays(
                    [
                        taken.column("label"), taken.column("width"), pa.array(np.concatenate((cell, to)).astype(np.int32)),
                        pa.array(np.arange(len(every)) >= len(rows)), taken.column("node"), taken.column("copies"), taken.column("vector"),
                    ],
                    ["label", "width", "cell", "visitor", "node", "copies", "vector"],
                )

    return run


def _product(threshold: float):
    def run(key, table):
        """Links of the vectors of two blocks (rows marked ``side`` 0 and 1, or one block with itself)."""
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        vectors, side = unit(_matrix(table.column("vector"))), table.column("side").to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not key[-1].as_py()
        if alone:
            right = left
        linked = vectors[left] @ vectors[right].T >= threshold
        if alone:
            np.fill_diagonal(linked, False)
        sums = linked @ copies[right].astype(np.float64)
        rows, links = [node[left]], [sums]
        if not alone:
            rows.append(node[right])
            links.append(copies[left].astype(np.float64) @ linked)
        # The lowest numbered neighbour of each vector, and of the groups so found: enough to connect all that is linked.
        label = np.arange(len(node))
        a, b = np.nonzero(linked)
        a, b = left[a], right[b]
        while True:
            low = label.copy()
            np.minimum.at(low, a, label[b])
            np.minimum.at(low, b, label[a])
            low = low[low]
            if (low == label).all():
                break
            label = low
        row, total = np.concatenate(rows), np.concatenate(links)
        to = np.concatenate([node[label[left]]] + ([] if alone else [node[label[right]]]))
        held = total > 0
        return pa.table({"node": row[held], "to": to[held], "links": total[held].astype(np.int64)})

    return run


def linked(rows: DataFrame, cosine: float = COSINE, margin: float | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    margin = np.sqrt(1 - cosine * cosine) + 1e-9 if margin is None else margin
    source = rows.filter("vec_id IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("vector", lambda x: x != 0)
    source = source.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # -0.0 and 0.0 are the same component.
    same = F.transform("vector", lambda x: x + F.lit(0.0))
    keyed = source.filter("usable").withColumn("vector", same)
    distinct = keyed.groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    distinct = stage(distinct.withColumn("width", F.size("vector")), "vectors")
    total = distinct.count()
    share = F.lit(SAMPLE / max(1, total))
    draw = F.pmod(F.xxhash64("node", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    centres = {}
    for (width,) in distinct.select("width").distinct().collect() if total else []:  # lengths of vectors are few
        sample = distinct.filter((F.col("width") == width) & (draw < share)).select("node", "vector").toPandas().sort_values("node")  # SAMPLE bounds it
        some = unit(np.stack(sample["vector"])) if len(sample) else np.eye(1, width)
        centres[width] = spherical_k_means(some, int(min(CENTRES, total // PER_CELL + 1)))
    schema = "label {0}, width int, cell int, visitor boolean, node long, copies long, vector array<double>".format(dict(rows.dtypes)["label"])
    cells = distinct.select("label", "width", "node", "copies", "vector").mapInArrow(_to_cells(centres, margin), schema)
    cells = stage(cells, "cells")
    place = ("label", "width", "cell")
    sizes = cells.groupBy(*place).agg(*[(F.floor(F.sum(F.when(F.col("visitor") == v, 1).otherwise(0)) / BLOCK) + 1).cast("int").alias(n) for v, n in ((False, "own_blocks"), (True, "guest_blocks"))])
    spot = F.pmod(F.xxhash64("node"), F.when(F.col("visitor"), F.col("guest_blocks")).otherwise(F.col("own_blocks"))).cast("int")
    blocks = cells.join(sizes, list(place)).withColumn("block", spot)
    # Pairs of blocks: own blocks among each other (first <= second), and each own block with each block of visitors.
    up = F.expr("transform(sequence(block, own_blocks - 1), x -> struct(0 AS kind, block AS a, x AS b, if(x = block, -1, 0) AS side))")
    down = F.expr("if(block = 0, array(), transform(sequence(0, block - 1), x -> struct(0 AS kind, x AS a, block AS b, 1 AS side)))")
    meets = F.expr("transform(sequence(0, guest_blocks - 1), x -> struct(1 AS kind, block AS a, x AS b, 0 AS side))")
    guests = F.expr("transform(sequence(0, own_blocks - 1), x -> struct(1 AS kind, x AS a, block AS b, 1 AS side))")
    roles = F.when(F.col("visitor"), guests).otherwise(F.concat(up, down, meets))
    dealt = blocks.withColumn("role", F.explode(roles)).select(*place, "role.kind", "role.a", "role.b", "role.side", "node", "copies", "vector")
    dealt = dealt.withColumn("crossed", (F.col("kind") == 1) | (F.col("a") < F.col("b"))).withColumn("side", F.greatest("side", F.lit(0)))
    found = dealt.groupBy(*place, "kind", "a", "b", "crossed").applyInArrow(_product(cosine), "node long, to long, links long")
    found = stage(found, "vector-links")
    groups = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("others"))
    known = distinct.join(links, "node", "left").join(groups, "node", "left").select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"),
    )
    met = keyed.join(known, (keyed.label == F.col("_label")) & (keyed.vector == F.col("_vector"))).select("vec_id", "n_links", "component_id")
    rest = source.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return met.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))

"""Regularised boosted trees from histograms of gradients, one Spark job for each level of a tree.

Features are cut into at most ``bins`` ranges once and staged as one byte each, ``CHUNK_ROWS`` rows a value, so that a pass moves
blocks of bytes and no single rows. A job adds up gradients and rows by
(node, feature, range): every task has one histogram, and only its cells are shuffled and summed. The driver gets the cells,
nodes x features x ranges at most, whatever the number of rows, and picks the splits by their second-order gain

    G_left^2 / (H_left + penalty) + G_right^2 / (H_right + penalty) - G^2 / (H + penalty)

for squared error (a gradient is prediction - target, a Hessian 1). Trees grow to ``depth``; then splits that gain less than ``least_gain``
are taken back from below. A leaf is -step * G / (H + penalty). Each tree looks at ``share`` of the features, chosen by hash. Missing values go
to the side that gains more. Margins are staged again every few rounds, so a pass never evaluates more than those trees.

Losses of training and validation rows come with the first pass of the next round. With ``patience`` fitting ends when the
validation loss has not been lower for so many rounds, and the best round is kept; a fitted model can be given to go on from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.session import stage

MISSING = 255
ROUNDS_PER_STAGE = 10
#: Rows of a staged value, and bytes of a row group of such values, which is what a task reads at once.
CHUNK_ROWS = 1 << 13
GROUP_BYTES = 1 << 24
TRAIN_LOSS, LATE_LOSS = -1, -2
#: Up to so many cells of all tasks are summed by the driver; beyond it a shuffle sums them first.
DIRECT_CELLS = 1 << 20


@dataclass(frozen=True)
class Tree:
    """Nodes by number: 1 is the root, 2i and 2i + 1 are the children of i; a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 << depth
        whole = [np.zeros(size, kind) for kind in (np.int64, np.int64, float, bool, float, float, np.int64)]
        whole[0][:] = -1
        return cls(*whole)

    def by_code(self, codes: np.ndarray, out: np.ndarray) -> np.ndarray:
        """What ``out`` has for the node of each row, by the ranges of its features (feature x row)."""
        return self._spread(codes, lambda values: values == MISSING, self.cut, out)

    def by_value(self, values: np.ndarray, out: np.ndarray) -> np.ndarray:
        """What ``out`` has for the node of each row, by its values (feature x row)."""
        return self._spread(values, np.isnan, self.threshold, out)

    def _spread(self, values, missing, limit, out):
        # Whole columns are compared, a node at a time, and results chosen from the leaves up.
        def below(node):
            feature = self.feature[node]
            if feature < 0:
                return out[node]
            left = values[feature] <= limit[node]
            if self.missing_left[node]:
                left |= missing(values[feature])
            return np.where(left, below(2 * node), below(2 * node + 1))

        return np.broadcast_to(below(1), values.shape[1])


@dataclass(frozen=True)
class Boosted:
    features: list[str]
    base: float
    trees: list[Tree]
    #: (training, validation) mean squared error after each number of trees, from 0 on.
    losses: list[tuple[float, float]] = field(default_factory=list)

    def margins(self, values: np.ndarray) -> np.ndarray:
        return self.base + sum((t.by_value(values, t.value) for t in self.trees), np.zeros(values.shape[1]))


def chosen_features(features: Sequence[str], turn: int, share: float, seed: int) -> list[int]:
    """The features a tree looks at: the first ones by a hash of seed, tree and name."""
    ranked = sorted(range(len(features)), key=lambda i: hashlib.md5(f"{seed}:{turn}:{features[i]}".encode()).hexdigest())
    return sorted(ranked[: max(1, round(share * len(features)))])


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Upper limits of the ranges: all values but the last of a feature with few of them, else approximate quantiles."""
    clean = df.select(*[F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f) for f in features])
    shares = [i / bins for i in range(1, bins)]
    asked = [F.approx_count_distinct(f, 0.01).alias(f"n{i}") for i, f in enumerate(features)]
    asked += [F.percentile_approx(f, shares, 100 * bins).alias(f"q{i}") for i, f in enumerate(features)]
    row = clean.agg(*asked).head()
    few = [f for i, f in enumerate(features) if row[f"n{i}"] <= bins]
    sets = clean.agg(*[F.collect_set(f).alias(f) for f in few]).head() if few else {}  # the count above bounds them
    out = []
    for i, f in enumerate(features):
        out.append(np.array(sorted(sets[f])[:-1], float) if f in few else np.unique(np.array(row[f"q{i}"], float)))
    return out


CHUNKS = "codes binary, y binary, late binary, margin binary"


def _chunk(columns: Sequence[np.ndarray]) -> pa.RecordBatch:
    """One row: the codes (feature x row), targets, validation marks and margins of some rows."""
    kinds = (np.uint8, np.float64, np.bool_, np.float64)
    packed = [pa.array([np.ascontiguousarray(c, kind).tobytes()], pa.binary()) for c, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(packed, ["codes", "y", "late", "margin"])


def _codes(features: Sequence[str], edges: list[np.ndarray], model: Boosted):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in source:
            values = _values(batch, features)
            codes = [np.where(np.isnan(v), MISSING, np.searchsorted(e, v, "left")).astype(np.uint8) for v, e in zip(values, edges)]
            y, late = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_late"))
            held.append((np.stack(codes), y, late, model.margins(values)))
            rows += len(batch)
            if rows >= CHUNK_ROWS:
                whole = [np.concatenate(column, axis=-1) for column in zip(*held)]
                full = rows - rows % CHUNK_ROWS
                for at in range(0, full, CHUNK_ROWS):
                    yield _chunk([column[..., at : at + CHUNK_ROWS] for column in whole])
                held, rows = [[column[..., full:] for column in whole]], rows - full
        if rows:
            yield _chunk([np.concatenate(column, axis=-1) for column in zip(*held)])

    return run


def _values(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    return np.stack([batch.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features])


def _read(source: Iterator[pa.RecordBatch], width: int, recent: list[Tree]):
    """Codes (feature x row), target, validation mark and present margin of each chunk."""
    for batch in source:
        for codes, y, late, margin in zip(*(batch.column(c) for c in ("codes", "y", "late", "margin"))):
            codes = np.frombuffer(codes.as_buffer(), np.uint8).reshape(width, -1)
            margin = np.frombuffer(margin.as_buffer(), np.float64)
            for tree in recent:
                margin = margin + tree.by_code(codes, tree.value)
            yield codes, np.frombuffer(y.as_buffer(), np.float64), np.frombuffer(late.as_buffer(), np.bool_), margin


def _advanced(width: int, recent: list[Tree]):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _read(source, width, recent):
            yield _chunk(columns)

    return run


def _cells(width: int, recent: list[Tree], growing: Tree, nodes: list[int], use: list[int]):
    """(cell, g, n): sums of gradients and rows by (node, used feature, range), and with the first pass of a tree the losses."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(len(growing.feature), -1)
        slot[nodes] = np.arange(len(nodes))
        size = max(1, len(nodes)) * 256
        sums, rows, losses = np.zeros((len(use), size)), np.zeros((len(use), size), np.int64), np.zeros((2, 2))
        for codes, y, late, margin in _read(source, width, recent):
            error = margin - y
            if nodes in ([], [1]):
                for i, mark in enumerate((~late, late)):
                    losses[i] += (error[mark] ** 2).sum(), mark.sum()
            if not nodes:
                continue
            at = growing.by_code(codes, slot)
            held = (at >= 0) & ~late
            used, at = codes[use], at * 256
            if not held.all():
                used, at, error = used[:, held], at[held], error[held]
            for j, codes_of in enumerate(used):
                cell = at + codes_of
                sums[j] += np.bincount(cell, error, size)
                rows[j] += np.bincount(cell, minlength=size)
        # By node, feature and range.
        sums, rows = (x.reshape(len(use), max(1, len(nodes)), 256).swapaxes(0, 1).reshape(-1) for x in (sums, rows))
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((full, [TRAIN_LOSS, LATE_LOSS]))),
                pa.array(np.concatenate((sums[full], losses[:, 0]))),
                pa.array(np.concatenate((rows[full], losses[:, 1].astype(np.int64)))),
            ],
            ["cell", "g", "n"],
        )

    return run


def _passed(rows: DataFrame, parts: int, width: int, recent, growing, nodes, use) -> tuple[np.ndarray, np.ndarray, tuple[float, float]]:
    """Gradient sums and row counts (node, feature, range), and the mean losses."""
    cells = rows.mapInArrow(_cells(width, recent, growing, nodes, use), "cell long, g double, n long")
    shape = (max(1, len(nodes)), max(1, len(use)), 256)
    if parts * np.prod(shape) > DIRECT_CELLS:
        cells = cells.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    found = cells.toArrow()  # cells of one level, at most DIRECT_CELLS before they are summed
    place, g, n = (found.column(c).to_numpy() for c in ("cell", "g", "n"))
    inner = place >= 0
    sums = np.bincount(place[inner], g[inner], np.prod(shape)).reshape(shape)
    counts = np.bincount(place[inner], n[inner], np.prod(shape)).reshape(shape)
    totals = [(g[place == mark].sum(), n[place == mark].sum()) for mark in (TRAIN_LOSS, LATE_LOSS)]
    return sums, counts, tuple(float(a / b) if b else float("nan") for a, b in totals)


def best_split(sums: np.ndarray, counts: np.ndarray, penalty: float) -> tuple[float, int, int, bool, tuple, tuple]:
    """(gain, feature, range, whether missing values go left, (G, rows) left, right) of one node; of equal gains the first."""
    g, n = sums[0].sum(), counts[0].sum()
    best = (0.0, -1, 0, False, (0.0, 0.0), (0.0, 0.0))
    for f in range(len(sums)):
        known_g, known_n = np.cumsum(sums[f, :MISSING]), np.cumsum(counts[f, :MISSING])
        for missing_left in (False, True) if counts[f, MISSING] else (False,):
            left_g = known_g + (sums[f, MISSING] if missing_left else 0.0)
            left_n = known_n + (counts[f, MISSING] if missing_left else 0.0)
            gains = left_g**2 / (left_n + penalty) + (g - left_g) ** 2 / (n - left_n + penalty) - g**2 / (n + penalty)
            gains[(left_n < 1) | (n - left_n < 1)] = -np.inf
            at = int(np.argmax(gains))
            if gains[at] > best[0]:
                best = (float(gains[at]), f, at, missing_left, (left_g[at], left_n[at]), (g - left_g[at], n - left_n[at]))
    return best


def _grown(rows, parts, features, edges, recent, use, depth, step, penalty, least_gain) -> tuple[Tree, tuple[float, float]]:
    tree, nodes, held, losses = Tree.empty(depth), [1], {}, None
    for level in range(depth):
        sums, counts, loss = _passed(rows, parts, len(features), recent, tree, nodes, use)
        losses = losses or loss
        if level == 0:
            held[1] = (sums[0, 0].sum(), counts[0, 0].sum())
        children = []
        for i, node in enumerate(nodes):
            gain, f, cut, missing_left, left, right = best_split(sums[i], counts[i], penalty)
            if f < 0:
                continue
            tree.feature[node], tree.cut[node], tree.gain[node] = use[f], cut, gain
            limits = edges[use[f]]
            # Beyond the last limit the split is between known and missing values.
            tree.missing_left[node], tree.threshold[node] = missing_left, limits[cut] if cut < len(limits) else np.inf
            held[2 * node], held[2 * node + 1] = left, right
            children += [2 * node, 2 * node + 1]
        nodes = children
        if not nodes:
            break
    for node in sorted(held, reverse=True):
        inner = tree.feature[node] >= 0
        if inner and tree.gain[node] < least_gain and tree.feature[2 * node] < 0 and tree.feature[2 * node + 1] < 0:
            tree.feature[node], tree.gain[node] = -1, 0.0
        g, n = held[node]
        tree.value[node], tree.rows[node] = -step * g / (n + penalty) if n else 0.0, n
    return tree, losses


def stopped_at(losses: Sequence[float], patience: int) -> int | None:
    """The best number of trees once the last ``patience`` ones brought nothing, else None. losses[0] is that of one tree."""
    best = int(np.argmin(losses)) if len(losses) else 0
    return best + 1 if len(losses) - 1 - best >= patience else None


def _staged(chunks: DataFrame) -> DataFrame:
    return stage(chunks, "boosting-rows", {"parquet.block.size": str(GROUP_BYTES)})


def fit(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    rounds: int = 100,
    depth: int = 3,
    step: float = 0.3,
    penalty: float = 1.0,
    least_gain: float = 0.2,
    share: float = 0.5,
    bins: int = 64,
    seed: int = 42,
    late: Column | None = None,
    patience: int | None = None,
    start: Boosted | None = None,
) -> Boosted:
    """Fit on the rows with a known target; rows where ``late`` holds only measure the validation loss.

    ``rounds`` is the number of trees in all, those of ``start`` included. Without rows the model is the constant 0.
    """
    if not 1 <= bins <= MISSING:
        raise ValueError(f"bins is between 1 and {MISSING}")
    mark = F.coalesce(late, F.lit(False)) if late is not None else F.lit(False)
    known = df.where(F.col(target).isNotNull()).select(*features, F.col(target).cast("double").alias("_y"), mark.alias("_late"))
    train = known.where("NOT _late")
    edges = bin_edges(train, features, bins)
    model = start or Boosted(list(features), train.agg(F.avg("_y")).head()[0] or 0.0, [])
    rows = _staged(known.mapInArrow(_codes(model.features, edges, model), CHUNKS))
    trees, losses, recent = list(model.trees), list(model.losses), []
    parts = rows.rdd.getNumPartitions()
    while len(trees) < rounds:
        use = chosen_features(features, len(trees), share, seed)
        tree, loss = _grown(rows, parts, features, edges, recent, use, depth, step, penalty, least_gain)
        losses = [*losses[: len(trees)], loss]
        if patience and (best := stopped_at([x[1] for x in losses[1:]], patience)):
            return replace(model, trees=trees[:best], losses=losses[: best + 1])
        trees.append(tree)
        recent.append(tree)
        if len(recent) == ROUNDS_PER_STAGE:
            rows = _staged(rows.mapInArrow(_advanced(len(features), recent), CHUNKS))
            recent, parts = [], rows.rdd.getNumPartitions()
    losses = [*losses[: len(trees)], _passed(rows, parts, len(features), recent, Tree.empty(1), [], [])[2]]
    if patience:
        trees = trees[: int(np.argmin([x[1] for x in losses[1:]])) + 1] if len(losses) > 1 else trees
    return replace(model, trees=trees, losses=losses[: len(trees) + 1])


def predict(df: DataFrame, model: Boosted, out: str = "predicted") -> DataFrame:
    """Add the prediction; a null or NaN feature is a missing value."""

    @F.pandas_udf("double")
    def margins(columns: pd.DataFrame) -> pd.Series:
        return pd.Series(model.margins(columns.to_numpy(float).T))

    return df.withColumn(out, margins(F.struct(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(model.features)])))


def importance(spark: SparkSession, model: Boosted) -> DataFrame:
    """(feature, gain, splits, pct): summed gains of the splits on each feature, and their share of all."""
    gain, splits = np.zeros(len(model.features)), np.zeros(len(model.features), int)
    for tree in model.trees:
        inner = tree.feature >= 0
        np.add.at(gain, tree.feature[inner], tree.gain[inner])
        np.add.at(splits, tree.feature[inner], 1)
    total = gain.sum()
    rows = [(f, float(g), int(s), float(100 * g / total) if total else None) for f, g, s in zip(model.features, gain, splits)]
    return spark.createDataFrame(rows, "feature string, gain double, splits long, pct double")


TABLE = "tree int, node int, feature string, threshold double, missing_left boolean, value double, gain double, rows long"


def as_table(spark: SparkSession, model: Boosted) -> DataFrame:
    """The fitted parameters: one row for each node; tree -1 has the base value and, by node, the order of the features."""
    rows = [(-1, i, f, None, None, model.base, None, None) for i, f in enumerate(model.features)]
    for number, tree in enumerate(model.trees):
        reached = [1]
        for node in reached:
            f = int(tree.feature[node])
            if f >= 0:
                reached += [2 * node, 2 * node + 1]
            shown = (model.features[f], float(tree.threshold[node]), bool(tree.missing_left[node])) if f >= 0 else (None, None, None)
            rows.append((number, node, *shown, float(tree.value[node]), float(tree.gain[node]), int(tree.rows[node])))
    return spark.createDataFrame(rows, TABLE)


def from_table(parameters: DataFrame) -> Boosted:
    """The model of ``as_table``; it predicts as before and can be fitted on."""
    rows = sorted(parameters.collect(), key=lambda r: (r["tree"], r["node"]))  # a few rows for each tree
    heads = [r for r in rows if r["tree"] < 0]
    place = {r["feature"]: r["node"] for r in heads}
    trees: dict[int, Tree] = {}
    depth = max((r["node"].bit_length() for r in rows if r["tree"] >= 0), default=1)
    for r in rows:
        if r["tree"] < 0:
            continue
        tree, node = trees.setdefault(r["tree"], Tree.empty(depth)), r["node"]
        tree.value[node], tree.gain[node], tree.rows[node] = r["value"], r["gain"], r["rows"]
        if r["feature"] is not None:
            tree.feature[node], tree.threshold[node], tree.missing_left[node] = place[r["feature"]], r["threshold"], r["missing_left"]
    return Boosted([r["feature"] for r in heads], heads[0]["value"] if heads else 0.0, [trees[t] for t in sorted(trees)])


def save(spark: SparkSession, model: Boosted, path: str) -> None:
    as_table(spark, model).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Boosted:
    return from_table(spark.read.schema(TABLE).parquet(path))

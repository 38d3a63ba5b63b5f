"""Gradient boosting by Newton steps: M1-M4, A24.

A tree splits where the weighted variance of the Newton targets ``-g / h`` falls
most (weights ``h`` of the logistic loss), which is the largest
``G_l^2/H_l + G_r^2/H_r``. Its leaves get the values ``-G / (H + lambda)``, which is
the L2 penalty on leaves (G and H: sums of g and h). G and H of inner nodes are
sums over their leaves, so every split's raw gain is known too.

Rows lie in blocks: of each feature the block's distinct values and every row's
place among them, so that bins and nodes of rows are looked up by place and no
value is searched or compared again.

Several models (the folds) grow side by side, tree by tree: a tree's rows are put
in bins once, and a level takes one pass over them for all models: tasks count
their rows in histograms (node, feature, bin), histograms meet by node, and each
node's best split is found there. A split comes from at most ``max_bins``
candidates a feature, weighted quantiles of a sample of ``SPLIT_SAMPLE`` rows (all
rows, if fewer).

Blocks carry their rows' margins (the sum of the trees so far, one a model). After
``chunk`` trees the blocks are written with them, so the work before a tree never
holds more than ``chunk`` trees, however many came before, and a lost executor
costs one chunk at most.

Early stopping follows the held-out rows' AUC with patience: tasks count their
rows' margins after each of a chunk's trees in a histogram per iteration, one
aggregate adds them, and each iteration's AUC comes from its counts. If
``patience`` iterations bring nothing, growing ends and the ensemble is cut at
the best one.

The fitted trees are small tables (a row a node); scores of new rows come from
one vectorised pass over all trees of all models.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.session import remove, scratch_path

#: Histogram of margins for the AUC: bins of 1/1024, margins cut at +-32.
BINS_PER_UNIT, MARGIN_LIMIT = 1024, 32
#: Trees between two writes of the margins.
CHUNK = 10
MIN_HESSIAN = 1e-16
#: Stands for a missing value.
MISSING = 1e300
#: Rows that split candidates come from (a bounded sample by hash; trees see every row).
SPLIT_SAMPLE = 20_000
#: Rows of a block, and of a file of blocks when training starts.
FILE_ROWS = 25_000
#: Bytes of a level's histograms (tasks x nodes x bins) that the driver adds up itself; more are shuffled by node.
DIRECT_BYTES = 16 << 20
#: A gain below this share of a node's weighted squares is rounding.
NOISE = 1e-12

STATE = "n int, places binary, sizes binary, points binary, y binary, w binary, held binary, draw binary, margin binary"
COUNTS = "counts array<struct<held: int, iteration: int, bin: long, pos: long, neg: long>>"
NODE_SCHEMA = ("tree int, node int, feature string, threshold double, left_child int, right_child int, rows long, "
               "sum_grad double, sum_hess double, gain double, value double")


@dataclass
class BoostParams:
    """Settings of one model. ``reg_lambda``: L2 penalty on leaf values."""

    max_iter: int
    max_depth: int
    learning_rate: float
    subsample: float = 1.0             # rows of a tree, drawn by hash
    feature_share: float = 1.0         # features of a tree
    min_rows_leaf: int = 20
    reg_lambda: float = 1.0
    max_bins: int = 64
    chunk: int = CHUNK


@dataclass
class Tree:
    """Nodes in preorder: an inner node sends ``x[feature] <= threshold`` to the left."""

    feature: np.ndarray                # index, -1 in a leaf
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray                  # what a leaf adds to the margin
    rows: np.ndarray
    grad: np.ndarray
    hess: np.ndarray
    gain: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf (a node number) of every row."""
        at = np.zeros(len(x), np.int64)
        while True:
            f = self.feature[at]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                return at
            here = at[inner]
            below = x[inner, f[inner]] <= self.threshold[here]
            at[inner] = np.where(below, self.left[here], self.right[here])


@dataclass
class Booster:
    features: list[str]
    start: float                       # margin of the empty ensemble
    trees: list[Tree] = field(default_factory=list)
    best_iteration: int = 0            # trees in use
    history: list[tuple[int, float]] = field(default_factory=list)      # held-out AUC by iteration

    def used(self) -> list[Tree]:
        return self.trees[:self.best_iteration]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.used():
            out += t.value[t.leaves(x)]
        return out

    def node_rows(self) -> list[tuple]:
        out = []
        for k, t in enumerate(self.used()):
            for n in range(len(t.feature)):
                inner = t.feature[n] >= 0
                out.append((k, n, self.features[t.feature[n]] if inner else None, float(t.threshold[n]) if inner else None,
                            int(t.left[n]) if inner else None, int(t.right[n]) if inner else None, int(t.rows[n]),
                            float(t.grad[n]), float(t.hess[n]), float(t.gain[n]), None if inner else float(t.value[n])))
        return out

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The trees in use, a row a node (bounded by trees x leaves)."""
        return spark.createDataFrame(self.node_rows(), NODE_SCHEMA)


def walked(table: np.ndarray, rows: np.ndarray, feature: Sequence[int], cut: Sequence[int], left: Sequence[int],
           right: Sequence[int]) -> np.ndarray:
    """The leaf of each of the ``rows`` (columns of ``table``, which has a row a feature): they go
    to the left where the feature's entry is at most ``cut``. All rows take every level; in a leaf they stay."""
    feature, cut, left, right = (np.asarray(v, np.int64) for v in (feature, cut, left, right))
    inner, own = feature >= 0, np.arange(len(feature))
    child = np.stack([np.where(inner, right, own), np.where(inner, left, own)], axis=1).ravel()
    flat, base = table.ravel(), np.where(inner, feature, 0) * table.shape[1]
    at, level = np.zeros(len(rows), np.int64), np.array([0])
    while len(level := level[inner[level]]):
        below = flat.take(base.take(at) + rows) <= cut.take(at)
        at = child.take(2 * at + below)
        level = np.concatenate((left[level], right[level]))
    return at


def newton_value(grad: float, hess: float, reg_lambda: float) -> float:
    return -grad / (hess + reg_lambda) if hess + reg_lambda > 0 else 0.0


@dataclass
class Growth:
    """A tree while it grows, on binned features: nodes by level, children after
    their parent. A row goes to the left where its bin is at most ``cut``."""

    model: int
    columns: list[int]                 # the model's features that this tree may use
    thresholds: list[np.ndarray]       # split candidates of each, ascending
    feature: list[int] = field(default_factory=lambda: [-1])       # place in columns, -1 in a leaf
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    sums: list[tuple] = field(default_factory=lambda: [(0, 0.0, 0.0)])      # rows, G, H
    open: list[int] = field(default_factory=lambda: [0])           # nodes of the next level

    def bins(self) -> np.ndarray:
        """Where each feature's bins start in a node's histogram, and their number."""
        return np.cumsum([0, *(len(t) + 1 for t in self.thresholds)])

    def at(self, bins: np.ndarray) -> np.ndarray:
        """The node of every row, from its bins (a row a feature)."""
        return walked(bins, np.arange(bins.shape[1]), self.feature, self.cut, self.left, self.right)

    def split(self, node: int, feature: int, cut: int, left: tuple, right: tuple) -> None:
        self.feature[node], self.cut[node] = feature, cut
        for side, sums in ((self.left, left), (self.right, right)):
            side[node] = len(self.feature)
            self.open.append(len(self.feature))
            for values, start in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.sums, sums)):
                values.append(start)

    def tree(self, learning_rate: float, reg_lambda: float) -> Tree:
        order = []

        def preorder(k: int) -> None:
            order.append(k)
            if self.feature[k] >= 0:
                preorder(self.left[k])
                preorder(self.right[k])

        preorder(0)
        place = {k: i for i, k in enumerate(order)}
        n = len(order)
        feature, left, right = np.full(n, -1, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        threshold, rows, grad, hess, gain, value = np.full(n, math.nan), np.zeros(n, np.int64), *np.zeros((4, n))

        def part(k: int) -> float:
            return grad[k] ** 2 / (hess[k] + reg_lambda) if hess[k] + reg_lambda > 0 else 0.0

        for i in reversed(range(n)):                   # children come after their parent
            k = order[i]
            if self.feature[k] < 0:
                rows[i], grad[i], hess[i] = self.sums[k]
                value[i] = learning_rate * newton_value(grad[i], hess[i], reg_lambda)
                continue
            a, b = left[i], right[i] = place[self.left[k]], place[self.right[k]]
            feature[i], threshold[i] = self.columns[self.feature[k]], self.thresholds[self.feature[k]][self.cut[k]]
            rows[i], grad[i], hess[i] = rows[a] + rows[b], grad[a] + grad[b], hess[a] + hess[b]
            gain[i] = part(a) + part(b) - part(i)
        return Tree(feature, threshold, left, right, value, rows, grad, hess, gain)


def split_candidates(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Thresholds between distinct ``values`` (ascending, with their weights): all of
    them, or those nearest to ``most + 1`` equal shares of the weight."""
    between = (values[:-1] + values[1:]) / 2
    if len(between) <= most:
        return between
    up_to = np.cumsum(weights)
    stride, middle, out, at = up_to[-1] / (most + 1), (up_to[:-1] + up_to[1:]) / 2, [], 0
    target = stride
    while (at := max(at, int(np.searchsorted(middle, target, "right")))) < len(middle):
        out.append(between[at])
        target, at = target + stride, at + 1
    return np.array(out)


def _histograms(blocks: Iterator[tuple], growing: dict[int, Growth], part: int) -> Iterator[tuple]:
    """((model, node), (task, histograms of rows, G, H by feature and bin, sum of g^2/h))."""
    sums: dict[int, list] = {}
    for model, bins, g, h in blocks:
        tree = growing.get(model)
        if tree is None or not len(g):
            continue
        slot_of = np.full(len(tree.feature), -1)
        slot_of[tree.open] = np.arange(len(tree.open))
        slot = slot_of[tree.at(bins)]
        here = np.flatnonzero(slot >= 0)
        if not len(here):
            continue
        if len(here) < len(g):
            bins, g, h, slot = bins[:, here], g[here], h[here], slot[here]
        starts, nodes = tree.bins(), len(tree.open)
        if model not in sums:
            sums[model] = [np.zeros((3, nodes, starts[-1])), np.zeros(nodes)]
        hist, squares = sums[model]
        squares += np.bincount(slot, g * g / np.where(h > 0, h, 1), nodes)
        most = int(np.diff(starts).max(initial=1))
        row = slot * most
        for c, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            if b - a > 1:                              # else nothing to split
                key = row + bins[c]
                for k, weight in enumerate((None, g, h)):
                    hist[k, :, a:b] += np.bincount(key, weight, nodes * most).reshape(nodes, most)[:, :b - a]
    for model, (hist, squares) in sums.items():
        for slot, node in enumerate(growing[model].open):
            yield (model, node), (part, hist[:, slot].copy(), squares[slot])


def _best_of(hist: np.ndarray, squares: np.ndarray, starts: np.ndarray, min_rows: int) -> list[tuple | None]:
    """For each node (its histograms of rows, G and H by bin, and its squares): (feature, cut,
    (rows, G, H) to the left, the same to the right); the first of equal gains, None if
    nothing lowers the variance. All nodes of a model at once."""
    every, noise = np.arange(len(hist)), NOISE * squares
    found = []
    for c, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        if b - a < 2:
            continue
        left = np.cumsum(hist[:, :, a:b - 1], axis=2)
        right = np.cumsum(hist[:, :, b - 1:a:-1], axis=2)[:, :, ::-1]
        whole = left[:, :, :1] + right[:, :, :1]
        ok = (left[:, 0] >= min_rows) & (right[:, 0] >= min_rows) & (left[:, 2] > 0) & (right[:, 2] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, left[:, 1] ** 2 / left[:, 2] + right[:, 1] ** 2 / right[:, 2] - whole[:, 1] ** 2 / whole[:, 2], -np.inf)
        cut = (gain >= gain.max(axis=1, keepdims=True) - noise[:, None]).argmax(axis=1)
        found.append((gain[every, cut], c, cut, left[every, :, cut], right[every, :, cut]))
    out: list[tuple | None] = []
    for k in every:
        best = max((f[0][k] for f in found), default=0.0)
        if best <= noise[k]:
            out.append(None)
            continue
        _, c, cut, left, right = next(f for f in found if f[0][k] >= best - noise[k])
        out.append((c, int(cut[k]), *((int(v[0]), float(v[1]), float(v[2])) for v in (left[k], right[k]))))
    return out


def _best_splits(counted: Iterable[tuple], starts: dict[int, np.ndarray], min_rows: int) -> Iterator[tuple]:
    """((model, node), its best split) of all nodes whose histograms meet here."""
    parts: dict[tuple, list] = {}
    for key, part in counted:
        parts.setdefault(key, []).append(part)
    for model in sorted({m for m, _ in parts}):
        keys = [k for k in parts if k[0] == model]
        of_node = [sorted(parts[k], key=lambda p: p[0]) for k in keys]            # sums in one order, whatever came first
        hist, squares = (np.array([sum(p[i] for p in of) for of in of_node]) for i in (1, 2))
        yield from zip(keys, _best_of(hist, squares, starts[model], min_rows), strict=True)


def _grow(blocks: RDD, growing: dict[int, Growth], params: BoostParams) -> None:
    """Grows the trees of all models, a pass over the blocks a level."""
    parts = blocks.getNumPartitions()
    for _ in range(params.max_depth):
        now = {m: t for m, t in growing.items() if t.open}
        if not now:
            return
        starts, min_rows = {m: t.bins() for m, t in now.items()}, params.min_rows_leaf
        nodes = sum(len(t.open) for t in now.values())
        counted = blocks.mapPartitionsWithIndex(lambda part, rows: _histograms(rows, now, part))
        size = parts * sum(24 * len(t.open) * int(t.bins()[-1]) for t in now.values())
        if 1 < parts and size <= DIRECT_BYTES:         # few small histograms: a shuffle would take longer than counting
            found = dict(_best_splits(counted.collect(), starts, min_rows))
        else:
            if parts > 1:                              # a histogram a task and node: a node's lie in one group, as many as tasks
                counted = counted.partitionBy(min(nodes, parts))
            found = dict(counted.mapPartitions(lambda c: _best_splits(c, starts, min_rows)).collect())   # a row a node
        for m, t in now.items():
            level, t.open = t.open, []
            for node in level:
                best = found.get((m, node))
                if best is not None:
                    t.split(node, *best)


def _margin_rows(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _margin_bin(margin: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(margin, -MARGIN_LIMIT, MARGIN_LIMIT) * BINS_PER_UNIT).astype(np.int64)


def staged_auc(rows: DataFrame, label: str, stages: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group ``by``, ``iteration`` (the place in the array ``stages``, from 0) and the ROC-AUC of
    its margins, ties in a bin counted half: margins are counted in bins, one
    aggregate for all iterations; null where a class is empty."""
    cut = F.greatest(F.least(F.col("m"), F.lit(float(MARGIN_LIMIT))), F.lit(-float(MARGIN_LIMIT)))
    return auc_of_counts(
        rows.select(*by, F.col(label).alias("y"), F.posexplode(stages).alias("iteration", "m"))
        .select(*by, "iteration", F.floor(cut * BINS_PER_UNIT).alias("bin"), F.when(F.col("y") == 1, 1).otherwise(0).alias("pos"),
                F.when(F.col("y") == 1, 0).otherwise(1).alias("neg")), by)


def auc_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``staged_auc`` from rows of one bin: by, iteration, bin, pos and neg."""
    counts = counts.groupBy(*by, "iteration", "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    below = Window.partitionBy(*by, "iteration").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("under", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    sums = ranked.groupBy(*by, "iteration").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"),
                                           F.sum(F.col("pos") * (F.col("under") + F.col("neg") / 2)).alias("wins"))
    return sums.select(*by, "iteration", F.when((F.col("p") > 0) & (F.col("n") > 0),
                                           F.col("wins") / (F.col("p").cast("double") * F.col("n"))).alias("auc"))


class Patience:
    """The best iteration so far, and whether ``rounds`` iterations since brought nothing."""

    def __init__(self, rounds: int):
        self.rounds, self.best, self.best_at, self.seen = rounds, -math.inf, 0, 0

    def tell(self, auc: float | None) -> bool:
        """Notes the next iteration's AUC; True once growing should end."""
        self.seen += 1
        if auc is not None and auc > self.best:
            self.best, self.best_at = auc, self.seen
        return self.rounds > 0 and self.seen - self.best_at >= self.rounds


def _finite(name: str) -> Column:
    """A feature as Spark's trees take it: a missing value is larger than all
    others, so it goes to the right of every split, as in scoring."""
    top = F.lit(MISSING)
    value = F.nanvl(F.coalesce(F.col(name).cast("double"), top), top)
    return F.greatest(F.least(value, top), -top)


def _gradient(y: np.ndarray, margin: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        p = 1 / (1 + np.exp(-margin))
    return w * (p - y), w * np.maximum(p * (1 - p), MIN_HESSIAN)


def _numbers(rows: pa.Table, n_features: int, n_models: int) -> dict:
    """The columns of rows; x: a column a feature, draw: a column a model."""
    out = {c: rows.column(c).to_numpy() for c in ("y", "w", "held")}
    out["draw"] = rows.column("draw").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, n_models)
    out["x"] = np.empty((rows.num_rows, n_features), order="F")
    for k in range(n_features):
        out["x"][:, k] = rows.column(f"f{k}")
    return out


_P1, _P2, _P3, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5


def hashed_on(hashes: np.ndarray, value: int) -> np.ndarray:
    """Spark's ``xxhash64(..., lit(value))`` from the hashes of what comes before an int."""
    h = hashes.view(np.uint64) + np.uint64(_P5 + 4)
    h = h ^ np.uint64((value & 0xFFFFFFFF) * _P1 & (1 << 64) - 1)
    h = (h << np.uint64(23) | h >> np.uint64(41)) * np.uint64(_P2) + np.uint64(_P3)
    h = (h ^ h >> np.uint64(33)) * np.uint64(_P2)
    h = (h ^ h >> np.uint64(29)) * np.uint64(_P3)
    return (h ^ h >> np.uint64(32)).view(np.int64)


def _drawn(hashes: np.ndarray, turn: int, share: float) -> np.ndarray:
    """The rows that a tree draws, by their hashes with the model's seed."""
    return hashed_on(hashes, turn) % 1000 < int(1000 * share)


class _Block:
    """Rows in memory: of each feature the ``points`` (distinct values, ascending) and the rows' ``places`` among them."""

    def __init__(self, row, n_features: int, n_models: int):
        n = self.n = row["n"]
        narrow = np.uint8 if len(row["places"]) == n_features * n else np.uint16
        self.places = np.frombuffer(row["places"], narrow).reshape(n_features, n)
        self.points = np.split(np.frombuffer(row["points"]), np.cumsum(np.frombuffer(row["sizes"], np.int32))[:-1])
        self.y, self.w, self.held = (np.frombuffer(row[c], t) for c, t in (("y", np.float64), ("w", np.float64), ("held", np.int32)))
        self.draw, self.margin = (np.frombuffer(row[c], t).reshape(n_models, n) for c, t in (("draw", np.int64), ("margin", np.float64)))

    def bins(self, column: int, rows: np.ndarray, thresholds: np.ndarray, dtype) -> np.ndarray:
        return np.searchsorted(thresholds, self.points[column], "left").astype(dtype)[self.places[column, rows]]

    def gains(self, tree: Tree, rows: np.ndarray) -> np.ndarray:
        """What the tree adds to the margins of rows."""
        cut = [int(np.searchsorted(self.points[f], t, "right")) - 1 if f >= 0 else 0 for f, t in zip(tree.feature, tree.threshold, strict=True)]
        return tree.value[walked(self.places, rows, tree.feature, cut, tree.left, tree.right)]


def _packed(rows: DataFrame, n_features: int, starts: Sequence[float]) -> DataFrame:
    """Rows as blocks (``STATE``) of at most ``FILE_ROWS``, with the margins of empty models."""
    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        r = _numbers(pa.Table.from_batches(parts), n_features, len(starts))
        n = len(r["y"])
        points, places = zip(*(np.unique(r["x"][:, k], return_inverse=True) for k in range(n_features)), strict=True)
        narrow = np.uint8 if max(map(len, points)) <= 256 else np.uint16
        row = (np.array(places, narrow), np.array([len(p) for p in points], np.int32), np.concatenate(points), r["y"].astype(float),
               r["w"].astype(float), r["held"].astype(np.int32), r["draw"].T, np.repeat(np.array(starts, float), n))
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in row)],
                                          [f.split()[0] for f in STATE.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                parts.append(batch.slice(at, FILE_ROWS - n))
                at, n = at + parts[-1].num_rows, n + parts[-1].num_rows
                if n == FILE_ROWS:
                    yield block(parts)
                    parts, n = [], 0
        if parts:
            yield block(parts)

    return rows.mapInArrow(pack, STATE)


def _binned(rows: Iterator, n_features: int, models: int, growing: dict[int, Growth], chunk: dict[int, list[Tree]], turn: int,
            share: float, dtype) -> Iterator[tuple]:
    """A tree's rows of every model, a block at a time: model, bins, g and h."""
    for row in rows:
        block = _Block(row, n_features, models)
        for m, tree in growing.items():
            mine = np.flatnonzero((block.held != m) & _drawn(block.draw[m], turn, share))
            margin = block.margin[m, mine]
            for t in chunk[m]:
                margin += block.gains(t, mine)
            g, h = _gradient(block.y[mine], margin, block.w[mine])
            bins = np.empty((len(tree.columns), len(mine)), dtype)
            for k, (c, thresholds) in enumerate(zip(tree.columns, tree.thresholds, strict=True)):
                bins[k] = block.bins(c, mine, thresholds, dtype)
            yield m, bins, g, h


def _moved(state: DataFrame, n_features: int, models: int, chunk: dict[int, list[Tree]]) -> DataFrame:
    """Blocks with the chunk's trees in their margins, and ``counts``: histograms of the
    margins of the model that holds a row out, after each tree."""
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                block = _Block(one.to_pylist()[0], n_features, models)
                margin, every, found = block.margin.copy(), np.arange(block.n), [np.zeros((5, 0), np.int64)]
                for m, trees in chunk.items():
                    out = np.flatnonzero(block.held == m)
                    for k, t in enumerate(trees):
                        margin[m] += block.gains(t, every)
                        key, n = np.unique(_margin_bin(margin[m, out]) * 2 + (block.y[out] == 1), return_counts=True)
                        found.append(np.array([np.full(len(key), m), np.full(len(key), k), key >> 1, n * (key & 1), n * (1 - (key & 1))]))
                counts = np.concatenate(found, axis=1)
                items = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(counts, (pa.int32(), pa.int32(), *[pa.int64()] * 3), strict=True)],
                                                   ["held", "iteration", "bin", "pos", "neg"])
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:-1], pa.array([margin.tobytes()], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, counts.shape[1]], pa.int32()), items)], [*one.schema.names, "counts"])

    return state.mapInArrow(move, f"{STATE}, {COUNTS}")


class _Candidates:
    """Split candidates of a tree, from the sampled rows: values weigh the h of the
    rows that the tree draws."""

    def __init__(self, sampled: pa.Table, n_features: int, starts: Sequence[float]):
        self.rows = _numbers(sampled, n_features, len(starts))
        self.rows["margin"] = np.tile(np.array(starts, float), (sampled.num_rows, 1))
        self.values, self.codes = zip(*(np.unique(self.rows["x"][:, k], return_inverse=True) for k in range(n_features)), strict=True)

    def of(self, model: int, columns: Sequence[int], turn: int, share: float, max_bins: int) -> list[np.ndarray]:
        r = self.rows
        mine = np.flatnonzero((r["held"] != model) & _drawn(np.ascontiguousarray(r["draw"][:, model]), turn, share))
        if not len(r["y"]):
            return [np.zeros(0) for _ in columns]
        _, h = _gradient(r["y"][mine], r["margin"][mine, model], r["w"][mine])
        out = []
        for c in columns:
            codes, n = self.codes[c][mine], len(self.values[c])
            there = np.bincount(codes, minlength=n) > 0
            out.append(split_candidates(self.values[c][there], np.bincount(codes, h, n)[there], min(max_bins, max(len(mine), 1)) - 1))
        return out

    def move(self, model: int, tree: Tree) -> None:
        self.rows["margin"][:, model] += tree.value[tree.leaves(self.rows["x"])]


def fit(rows: DataFrame, features: Sequence[str], params: BoostParams, label: str = "label", weight: str | None = None,
        held: Column | None = None, patience: int = 0, seed: int = 42) -> Booster:
    """Boosts on the rows outside ``held``; with ``patience`` the held-out rows'
    AUC ends it and cuts the ensemble at its best iteration (0: all trees)."""
    fold = F.when(held, F.lit(0)) if held is not None else F.lit(None).cast("int")
    return fit_folds(rows, features, params, fold, [seed], label, weight, patience)[0]


def fit_folds(rows: DataFrame, features: Sequence[str], params: BoostParams, fold: Column, seeds: Sequence[int],
              label: str = "label", weight: str | None = None, patience: int = 0) -> list[Booster]:
    """A model a seed, grown side by side: model m boosts on the rows whose ``fold``
    is not m, and the others are held out of it."""
    spark, features, n_models = rows.sparkSession, list(features), len(seeds)
    y, w = F.col(label).cast("double"), F.col(weight).cast("double") if weight else F.lit(1.0)
    base = rows.select(*(_finite(c).alias(f"f{k}") for k, c in enumerate(features)), y.alias("y"), w.alias("w"),
                       F.coalesce(fold.cast("int"), F.lit(-1)).alias("held"), F.xxhash64(*rows.columns).alias("id"))
    total = base.agg(F.count(F.lit(1)).alias("n"), *(f(F.when(F.col("held") != m, v)).alias(f"{c}{m}") for m in range(n_models)
                     for c, f, v in (("n", F.count, F.lit(1)), ("p", F.sum, F.col("w") * F.col("y")), ("w", F.sum, F.col("w"))))).first()
    models = []
    for m in range(n_models):
        if not total[f"n{m}"]:
            raise ValueError("no training rows")
        mean = min(max(total[f"p{m}"] / total[f"w{m}"], 1e-12), 1 - 1e-12) if total[f"w{m}"] else 0.5
        models.append(Booster(features, math.log(mean / (1 - mean))))
    stops, rngs = [Patience(patience) for _ in seeds], [np.random.default_rng(s) for s in seeds]
    some = max(1, round(params.feature_share * len(features)))
    dtype = np.uint8 if params.max_bins <= 256 else np.uint16

    starts = [m.start for m in models]
    sampled = F.pmod(F.xxhash64("id", F.lit("splits")), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SPLIT_SAMPLE / total["n"]))
    drawing = base.withColumn("draw", F.array(*(F.xxhash64("id", F.lit(s)) for s in seeds)))
    candidates = _Candidates(drawing.where(sampled).toArrow().sort_by("id"), len(features), starts)     # about SPLIT_SAMPLE rows
    path = scratch_path(spark, "boost-rows")
    spread = drawing.repartition(-(-total["n"] // FILE_ROWS), "id").sortWithinPartitions("id")
    state = _margin_rows(_packed(spread, len(features), starts), path)
    active, first = list(range(n_models)), 0
    while active and first < params.max_iter:
        chunk: dict[int, list[Tree]] = {m: [] for m in active}
        # Fewer, longer tasks write fewer histograms; each goes through its blocks one at a time.
        loaded = state.rdd
        loaded = loaded.coalesce(max(spark.sparkContext.defaultParallelism, loaded.getNumPartitions() // 4))
        loaded = loaded.map(lambda r: r.asDict()).persist(StorageLevel.MEMORY_AND_DISK)        # kept as Python writes them, which is read faster
        growers = list(active)
        for turn in range(min(params.chunk, params.max_iter - first)):
            growing = {}
            for m in growers:
                columns = sorted(rngs[m].choice(len(features), some, replace=False).tolist())
                growing[m] = Growth(m, columns, candidates.of(m, columns, first + turn, params.subsample, params.max_bins))
            blocks = loaded.mapPartitions(partial(_binned, n_features=len(features), models=n_models, growing=growing, chunk=dict(chunk),
                                                  turn=first + turn, share=params.subsample, dtype=dtype)).persist(StorageLevel.MEMORY_AND_DISK)
            _grow(blocks, growing, params)
            blocks.unpersist()
            for m, grown in growing.items():
                if len(grown.feature) == 1:
                    growers.remove(m)                  # nothing splits any more
                    continue
                tree = grown.tree(params.learning_rate, params.reg_lambda)
                models[m].trees.append(tree)
                chunk[m].append(tree)
                candidates.move(m, tree)
            if not growers:
                break
        first += params.chunk
        old, path = path, scratch_path(spark, "boost-rows")
        written = _margin_rows(_moved(state, len(features), n_models, chunk), path)
        loaded.unpersist()
        remove(spark, old)
        state = written.drop("counts")
        found = {}
        if patience > 0:
            found = {(r["held"], r["iteration"]): r["auc"]                                 # a row a model and tree
                     for r in auc_of_counts(written.select(F.inline("counts")), ["held"]).collect()}
        for m in active:
            for i in range(len(chunk[m]) if patience > 0 else 0):
                models[m].history.append((stops[m].seen + 1, found.get((m, i))))
                if stops[m].tell(found.get((m, i))):
                    growers = [g for g in growers if g != m]
                    break
        active = growers
    remove(spark, path)
    for model, stop in zip(models, stops, strict=True):
        model.best_iteration = stop.best_at if patience > 0 and stop.best_at else len(model.trees)
    return models


def _lean(model: Booster) -> Booster:
    """What scoring needs of a model: this travels with the tasks."""
    none = np.zeros(0)
    return Booster([], model.start, [Tree(t.feature, t.threshold, t.left, t.right, t.value, none, none, none, none)
                                     for t in model.used()], model.best_iteration)


def probability(models: Sequence[Booster], features: Sequence[str], fold: str | None = None) -> Column:
    """The mean positive probability over the models, or that of the one model
    whose number the column ``fold`` holds: one vectorised pass over the rows."""
    lean = [_lean(m) for m in models]

    def sigmoid(m: Booster, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-m.margin(x)))

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for which, *columns in parts:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            if fold is None:
                yield pd.Series(sum(sigmoid(m, x) for m in lean) / len(lean))
                continue
            out, own = np.full(len(x), np.nan), which.to_numpy()
            for f, m in enumerate(lean):
                here = np.flatnonzero(own == f)
                out[here] = sigmoid(m, x[here])
            yield pd.Series(out)

    return score(F.col(fold) if fold else F.lit(0), *(F.col(c).cast("double") for c in features))


def gain_importance(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Raw gain summed over the splits of every feature (0 where it has none)."""
    named = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    gains = nodes.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum("gain").alias("importance"))
    return named.join(F.broadcast(gains), "feature", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))

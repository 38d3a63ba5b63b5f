"""Operator 11: hard-negative mining with a cover tree.

Each component x becomes the integer floor(scale * x); a score is the inner
product of two such vectors. An anchor's positives are its best other rows of
its own label; for each positive, the negatives are the best rows of other
labels whose score lies in a window below the positive's.

Candidates are augmented by sqrt(M^2 - |x|^2), M the largest norm, so that all
lie on one sphere and an inner product falls as the distance to the query
grows: q.x = (|q|^2 + M^2 - d(q, x)^2) / 2. A node with centre c and covering
radius r then holds only scores between the values at d(q, c) + r and at
d(q, c) - r. The tree has these levels:

* cells around pivots (a bounded number, the least hashes), each row in the
  nearest one's;
* shards of at most ``SHARD`` rows: a cell in order of the distance to its
  pivot, cut by the place in it (numbered over all tasks);
* inside a shard, ``FAN`` children a node, chosen farthest first until they
  cover it at half the radius, down to leaves of ``LEAF`` rows. Radii are
  measured, so bounds hold at every level.

Distinct anchors are searched in blocks of ``QBLOCK``. A block first visits the
shards of its own cells, which gives each anchor a floor; then all others
whose bounds reach its floors. In a visit each anchor takes its leaves in the
order of their upper bounds, a few at a time, until none can reach its floor or
its windows; leaf scores are exact. Blocks and shards meet by joins on rows of
bounded size; no vector travels through the driver except the pivots.

Rows of one vector and label tie in every score, so the first few ids of each
such group are all that a result can need: a vector that a third of the rows
share is a few candidates, and as an anchor one query.

Defined results: rows with a null id, label or vector, with a null or
non-finite component, with another number of components than most, or with an
integer norm of 2^31 or more (their scores may exceed a long) take no part;
zero vectors do. Ties go to the smaller id. Repeated rows count once; rows of
one id that differ are rows of their own, and "other" means of another id. An
anchor without positives has no rows, nor has a positive without negatives;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.ranking import global_row_number, row_number_within
from cartwheel.llm.common import Scratch

SHARD, FAN, LEAF = 1024, 16, 64
#: Shards that one task searches together, and anchors of a block.
PART_BITS, QBLOCK = 4, 1024
#: Pivots at most, and bytes of them: they travel with the task.
MAX_PIVOTS, PIVOT_BYTES = 1024, 8 << 20
#: Shares of the shards that every block meets, a task each.
DEALS = 64
#: Leaves that an anchor takes before floors are raised.
STEP = 16
#: Rounding of bounds, relative to M^2.
SLACK = 1e-6
_NORM_LIMIT = 2.0 ** 62


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """A column of packed vectors (64-bit integers) as a matrix of doubles."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<i8").reshape(len(column), dim).astype(float)


def integer_rows(vectors: DataFrame, scale: float, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """vec_id, label, z (packed integer components) and n2 of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))))
    top = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    rows = rows.where(F.size("v") == (top.d if top else 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            with np.errstate(over="ignore"):
                z = np.floor(scale * x)
                n2 = (z * z).sum(axis=1)
            fit = np.flatnonzero(n2 < _NORM_LIMIT)
            z = z[fit].astype("<i8")
            keep = pa.array(fit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).take(keep), pa.array([r.tobytes() for r in z], pa.binary()),
                 pa.array(n2[fit])], ["vec_id", "label", "z", "n2"])

    return rows.mapInArrow(pack, "vec_id long, label long, z binary, n2 double")


# ---- the tree ----

def _squared(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray, m2: float) -> np.ndarray:
    """Squared distances of augmented rows (x, a) to the point (y, b)."""
    return np.maximum(2 * (m2 - x @ y - a * b), 0)


def cover_tree(x: np.ndarray, m2: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the rows, nodes (centre, start, end, parent, whether a leaf) in
    that order, parents first, and their covering radii."""
    n2 = (x * x).sum(axis=1)
    a = np.sqrt(np.maximum(m2 - n2, 0))
    order, nodes, radii = np.arange(len(x)), [], []
    open_nodes = [(0, 0, len(x), -1)]
    while open_nodes:
        centre, start, end, parent = open_nodes.pop()
        mine = order[start:end]
        d2 = _squared(x[mine], a[mine], x[centre], a[centre], m2)
        radius = float(np.sqrt(d2.max()))
        leaf = end - start <= LEAF or radius == 0
        me = len(nodes)
        nodes.append([centre, start, end, parent, leaf])
        radii.append(radius)
        if leaf:
            continue
        centres, near, owner = [centre], d2, np.zeros(end - start, int)
        while len(centres) < FAN and near.max() > (radius / 2) ** 2:
            far = mine[int(near.argmax())]
            d = _squared(x[mine], a[mine], x[far], a[far], m2)
            closer = d < near
            owner[closer], near = len(centres), np.where(closer, d, near)
            centres.append(far)
        by = np.argsort(owner, kind="stable")
        order[start:end] = mine[by]
        cut = start + np.searchsorted(owner[by], np.arange(len(centres) + 1))
        open_nodes += [(c, int(s), int(e), me) for c, s, e in zip(centres, cut[:-1], cut[1:], strict=True) if e > s]
    nodes = np.array(nodes, dtype="<i8")
    at = np.empty(len(x), int)
    at[order] = np.arange(len(x))
    nodes[:, 0] = at[nodes[:, 0]]
    return order, nodes, np.array(radii)


SHARD_SCHEMA = ("shard long, cell long, centre array<double>, radius double, z binary, label binary, id binary, "
                "nodes binary, radii binary")


def _shards(placed: DataFrame, m2: float, dim: int) -> DataFrame:
    """Packs rows (cell, far, vec_id, label, z) into shards, each with its tree."""
    def pack(rows: pa.Table) -> pa.Table:
        z, label, ids = _matrix(rows["z"], dim), rows["label"].to_numpy(), rows["vec_id"].to_numpy()
        order, nodes, radii = cover_tree(z, m2)
        z, label, ids = (v[order].astype("<i8") for v in (z, label, ids))
        return pa.Table.from_pylist([{
            "shard": rows["shard"][0].as_py(), "cell": rows["cell"][0].as_py(), "centre": z[nodes[0, 0]].astype(float).tolist(),
            "radius": float(radii[0]), "z": z.tobytes(), "label": label.tobytes(), "id": ids.tobytes(),
            "nodes": nodes.tobytes(), "radii": radii.tobytes()}], schema=pa.schema(
                [("shard", pa.int64()), ("cell", pa.int64()), ("centre", pa.list_(pa.float64())), ("radius", pa.float64())]
                + [(c, pa.binary()) for c in ("z", "label", "id", "nodes", "radii")]))
    rows = row_number_within(placed.select("cell", "far", "vec_id", "label", "z"), ["cell"], ["far", "z", "label", "vec_id"], "n")
    shard = F.shiftleft("cell", 32) + F.floor((F.col("n") - 1) / SHARD)
    return rows.select("cell", "vec_id", "label", "z", shard.alias("shard")).groupBy("shard").applyInArrow(pack, SHARD_SCHEMA)


def _place(rows: DataFrame, pivots: np.ndarray, m2: float) -> DataFrame:
    """Adds each row's nearest pivot (cell) and its squared distance (far)."""
    p2 = (pivots * pivots).sum(axis=1)
    pa_ = np.sqrt(np.maximum(m2 - p2, 0))
    names = rows.columns

    def near(batches):
        for batch in batches:
            x = _matrix(batch.column(names.index("z")), pivots.shape[1])
            a = np.sqrt(np.maximum(m2 - (x * x).sum(axis=1), 0))
            d2 = np.maximum(2 * (m2 - x @ pivots.T - np.outer(a, pa_)), 0)
            cell = d2.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64()), pa.array(d2[np.arange(len(x)), cell])],
                                             [*names, "cell", "far"])
    kinds = ", ".join(f"{n} {k}" for n, k in rows.dtypes)
    return rows.mapInArrow(near, f"{kinds}, cell long, far double")


# ---- the search ----

def _bounds(q: np.ndarray, m2: float, z: np.ndarray, nodes: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of every query's scores in every node; a node's
    hold for what lies below it too."""
    half = ((q * q).sum(axis=1) + m2)[:, None] / 2
    d = np.sqrt(np.maximum(2 * half - 2 * (q @ z[nodes[:, 0]].T), 0))
    upper = half - np.maximum(d - radii, 0) ** 2 / 2 + SLACK * m2
    lower = half - (d + radii) ** 2 / 2 - SLACK * m2
    for k in range(1, len(nodes)):
        up = nodes[k, 3]
        np.minimum(upper[:, k], upper[:, up], out=upper[:, k])
        np.maximum(lower[:, k], lower[:, up], out=lower[:, k])
    return upper, lower


class Best:
    """The ``keep`` best (score, id) of every slot: a query's window."""

    def __init__(self, slots: int, keep: int):
        self.keep = keep
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(slots, -np.inf)
        self.new: list[tuple] = []

    def add(self, slot, score, ids) -> None:
        self.new.append((slot, score, ids))

    def settle(self) -> None:
        if not self.new:
            return
        slot, score, ids = (np.concatenate([old, *(n[k] for n in self.new)]) for k, old in enumerate((self.slot, self.score, self.id)))
        by = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[by], score[by], ids[by]
        first = np.searchsorted(slot, slot)
        rank = np.arange(len(slot)) - first
        self.slot, self.score, self.id = (v[rank < self.keep] for v in (slot, score, ids))
        last = rank == self.keep - 1
        self.floor[slot[last]] = score[last]
        self.new = []


def search_block(q: np.ndarray, label: np.ndarray, lo: np.ndarray, hi: np.ndarray, shards: list[tuple], keep: int,
                 same: bool, m2: float) -> Best:
    """For each query and window (lo, hi) the ``keep`` best scores inside it among
    the rows of its own label (``same``) or of others, over all shards
    (z, labels, ids, nodes, radii). ``lo`` also holds known floors."""
    nq, width = lo.shape
    best = Best(nq * width, keep)
    exact = m2 < 2.0 ** 53
    leaves, upper, lower = [], [], []
    for s, (z, _, _, nodes, radii) in enumerate(shards):
        up, low = _bounds(q, m2, z, nodes, radii)
        at = np.flatnonzero(nodes[:, 4])
        leaves += [(s, int(nodes[k, 1]), int(nodes[k, 2])) for k in at]
        upper.append(up[:, at])
        lower.append(low[:, at])
    upper, lower = np.hstack(upper), np.hstack(lower)
    order = np.argsort(-upper, axis=1, kind="stable")
    ints = None if exact else q.astype(np.int64)
    top = hi.max(axis=1)
    for start in range(0, len(leaves), STEP):
        need = np.maximum(lo, best.floor.reshape(nq, width))
        take = order[:, start:start + STEP]
        who = np.arange(nq)[:, None]
        up, low = upper[who, take], lower[who, take]
        reach = ((up[:, :, None] >= need[:, None, :]) & (low[:, :, None] <= hi[:, None, :])).any(axis=2)
        if not (up[:, :1] >= need.min(axis=1, keepdims=True)).any():
            break                                   # the rest lies below every floor
        qs, ks = np.nonzero(reach)
        ls = take[qs, ks]
        by = np.argsort(ls, kind="stable")
        qs, ls = qs[by], ls[by]
        least = need.min(axis=1)
        for at in np.split(np.arange(len(ls)), np.flatnonzero(np.diff(ls)) + 1) if len(ls) else ():
            s, a, b = leaves[ls[at[0]]]
            mine, (z, labels, ids) = qs[at], shards[s][:3]
            score = q[mine] @ z[a:b].T if exact else ints[mine] @ z[a:b].T.astype(np.int64)
            fit = (labels[a:b] == label[mine][:, None]) == same
            i, j = np.nonzero(fit & (score >= least[mine][:, None]) & (score <= top[mine][:, None]))
            who_, got, named = mine[i], score[i, j], ids[a + j]
            for w in range(width):
                ok = (got >= need[who_, w]) & (got <= hi[who_, w])
                if ok.any():
                    best.add(who_[ok] * width + w, got[ok].astype(np.int64), named[ok])
        best.settle()
    return best


VISIT = "q long, w int, score long, vec_id long"


def _visit(blocks: DataFrame, shards: DataFrame, pairs: DataFrame, keep: int, same: bool, m2: float, dim: int) -> DataFrame:
    """Searches the pairs (block, part, shard): q, w, score, vec_id, at most
    ``keep`` rows a query, window and task."""
    void = F.lit(None).cast("binary")
    trees = pairs.join(shards.drop("cell", "centre", "radius"), ["shard", "part"]).select(
        "block", "part", "z", "label", "id", "nodes", "radii", void.alias("lo"), void.alias("hi"))
    asked = pairs.select("block", "part").distinct().join(blocks, "block").select(
        "block", "part", "z", "label", "id", void.alias("nodes"), void.alias("radii"), "lo", "hi")

    def run(table: pa.Table) -> pa.Table:
        ints = lambda raw: np.frombuffer(raw, "<i8")                                  # noqa: E731
        trees, block = [], None
        for row in table.to_pylist():
            z = ints(row["z"]).reshape(-1, dim).astype(float)
            if row["nodes"] is None:
                block = (z, ints(row["label"]), ints(row["id"]), np.frombuffer(row["lo"]).reshape(len(z), -1),
                         np.frombuffer(row["hi"]).reshape(len(z), -1))
            else:
                trees.append((z, ints(row["label"]), ints(row["id"]), ints(row["nodes"]).reshape(-1, 5), np.frombuffer(row["radii"])))
        q, label, names, lo, hi = block
        best = search_block(q, label, lo, hi, trees, keep, same, m2)
        width = lo.shape[1]
        return pa.table({"q": pa.array(names[best.slot // width], pa.int64()), "w": pa.array(best.slot % width, pa.int32()),
                         "score": pa.array(best.score, pa.int64()), "vec_id": pa.array(best.id, pa.int64())})

    found = trees.unionAll(asked).groupBy("block", "part").applyInArrow(run, VISIT)
    best = Window.partitionBy("q", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= keep)


BLOCK_SCHEMA = ("block long, cells array<long>, centre array<double>, reach double, most double, least double, need double, "
                "cap double, z binary, label binary, id binary, lo binary, hi binary")


def _blocks(queries: DataFrame, dim: int) -> DataFrame:
    """Packs queries (block, cell, q, label, z, lo, hi) into a row a block, with
    what bounds it: a centre, the reach around it, norms, floors and caps."""
    def pack(rows: pa.Table) -> pa.Table:
        z = _matrix(rows["z"], dim)
        lo, hi = (np.array(rows[c].to_pylist(), float) for c in ("lo", "hi"))
        n2, centre = (z * z).sum(axis=1), z.mean(axis=0)
        return pa.Table.from_pylist([{
            "block": rows["block"][0].as_py(), "cells": sorted(set(rows["cell"].to_pylist())), "centre": centre.tolist(),
            "reach": float(np.sqrt(((z - centre) ** 2).sum(axis=1).max())), "most": float(n2.max()), "least": float(n2.min()),
            "need": float(lo.min()), "cap": float(hi.max()), "z": z.astype("<i8").tobytes(),
            "label": rows["label"].to_numpy().astype("<i8").tobytes(), "id": rows["q"].to_numpy().astype("<i8").tobytes(),
            "lo": lo.tobytes(), "hi": hi.tobytes()}], schema=pa.schema(
                [("block", pa.int64()), ("cells", pa.list_(pa.int64())), ("centre", pa.list_(pa.float64()))]
                + [(c, pa.float64()) for c in ("reach", "most", "least", "need", "cap")]
                + [(c, pa.binary()) for c in ("z", "label", "id", "lo", "hi")]))
    return queries.select("block", "cell", "q", "label", "z", "lo", "hi").groupBy("block").applyInArrow(pack, BLOCK_SCHEMA)


def _reaching(blocks: DataFrame, shards: DataFrame, m2: float) -> DataFrame:
    """Pairs (block, part, shard) whose bounds reach a floor and stay under a cap.
    Only centres and radii meet here, a row a block and a row a shard."""
    b = blocks.select("block", F.col("centre").alias("b_centre"), "reach", "most", "least", "need", "cap",
                      F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))).alias("deal"))
    s = shards.select("shard", "part", "centre", "radius", F.pmod(F.col("shard"), F.lit(DEALS)).cast("int").alias("deal"))
    both = b.join(s, "deal")
    b2 = F.aggregate("b_centre", F.lit(0.0), lambda t, x: t + x * x)
    dot = F.aggregate(F.zip_with("centre", "b_centre", lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    # The block's centre is a query (augmented by 0), the shard's a candidate on the sphere of M.
    d = F.sqrt(F.greatest(b2 + m2 - 2 * dot, F.lit(0.0)))
    near = F.greatest(d - F.col("reach") - F.col("radius"), F.lit(0.0))
    far = d + F.col("reach") + F.col("radius")
    upper = (F.col("most") + m2 - near * near) / 2 + SLACK * m2
    lower = (F.col("least") + m2 - far * far) / 2 - SLACK * m2
    return both.where((upper >= F.col("need")) & (lower <= F.col("cap"))).select("block", "part", "shard")


def _share(score: Column, part: tuple[int, int], up: bool) -> Column:
    """score * a / b rounded up or down, in whole numbers without overflow (a <= b)."""
    a, b = part
    rest = F.pmod(score, F.lit(b)) * a
    return F.floor((score - F.pmod(score, F.lit(b))) / b).cast("long") * a + (
        F.ceil(rest / b) if up else F.floor(rest / b)).cast("long")


def mine(vectors: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5, negatives: int = 3,
         low: tuple[int, int] = (50, 100), high: tuple[int, int] = (95, 100), scale: float = 256.0,
         id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score: for every anchor and each of its ``positives`` best rows of
    its label, the ``negatives`` best rows of other labels with
    low * positive_score <= negative_score <= high * positive_score."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    rows = scratch.write(integer_rows(vectors, scale, id_col, label_col, vec_col).distinct(), "mine-rows")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    facts = rows.agg(F.max("n2").alias("m2"), F.max(F.octet_length("z")).alias("bytes")).first()
    if facts.m2 is None:
        return spark.createDataFrame([], out)
    m2, dim = float(facts.m2), facts.bytes // 8
    anchors = rows.where(is_anchor(F.col("vec_id"))).select(F.col("vec_id").alias("anchor_id"), "label", "z")
    by_id = Window.partitionBy("z", "label").orderBy("vec_id")
    items = rows.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= max(positives + 1, negatives)).drop("r", "n2")
    items = scratch.write(items, "mine-items")

    pivots = max(1, min(MAX_PIVOTS, PIVOT_BYTES // (8 * dim), -(-items.count() // (SHARD << 3))))
    first = items.select("z").distinct().orderBy(F.xxhash64("z"), "z").limit(pivots).collect()       # bounded
    pivots = np.frombuffer(b"".join(r.z for r in first), "<i8").reshape(len(first), dim).astype(float)
    shards = scratch.write(_shards(_place(items, pivots, m2), m2, dim), "mine-shards")
    shards = shards.withColumn("part", F.shiftright("shard", PART_BITS))

    asked = anchors.select("label", "z").distinct().withColumn("q", F.monotonically_increasing_id())
    asked = _place(scratch.write(asked, "mine-asked"), pivots, m2)
    asked = scratch.write(global_row_number(asked, ["cell", "far", "q"], "n").withColumn(
        "block", F.floor((F.col("n") - 1) / QBLOCK)).drop("n", "far"), "mine-queries")
    number = anchors.join(asked.select("label", "z", "q"), ["label", "z"]).select("anchor_id", "q")

    # Positives: the own cells first, then what reaches the floors found there.
    def top(lo):
        return asked.join(lo, "q", "left").select("block", "cell", "q", "label", "z", F.array(F.coalesce("floor", F.lit(float("-inf")))).alias("lo"),
                                                  F.array(F.lit(float("inf"))).alias("hi"))
    none = asked.select("q", F.lit(None).cast("double").alias("floor"))
    blocks = scratch.write(_blocks(top(none), dim), "mine-blocks-1")
    home = (blocks.select("block", F.explode("cells").alias("cell")).join(shards.select("cell", "shard", "part"), "cell")
            .select("block", "part", "shard"))
    near = scratch.write(_visit(blocks, shards, home, positives + 1, True, m2, dim), "mine-near-1")
    floors = near.where(F.col("r") == positives + 1).select("q", F.col("score").cast("double").alias("floor"))
    blocks = scratch.write(_blocks(top(floors), dim), "mine-blocks-2")
    # A floor found at home is met again by the row that set it: shards of the own cells are visited once more.
    near = scratch.write(_visit(blocks, shards, _reaching(blocks, shards, m2), positives + 1, True, m2, dim), "mine-near-2")

    # Windows below the positives' scores.
    score = F.col("p.score")
    pos = near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "score", "vec_id"))).alias("ps"))
    windows = pos.select("q", "ps", F.transform("ps", lambda p: _share(p["score"], low, True).cast("double")).alias("lo"),
                         F.transform("ps", lambda p: _share(p["score"], high, False).cast("double")).alias("hi"))
    pad = lambda c, v: F.slice(F.concat(c, F.array_repeat(F.lit(v), positives + 1)), 1, positives + 1)      # noqa: E731
    windows = windows.withColumns({"lo": pad("lo", float("inf")), "hi": pad("hi", float("-inf"))})
    ready = asked.join(windows, "q").select("block", "cell", "q", "label", "z", "lo", "hi")
    blocks = scratch.write(_blocks(ready, dim), "mine-blocks-3")
    away = _visit(blocks, shards, _reaching(blocks, shards, m2), negatives, False, m2, dim)
    negs = away.groupBy("q", "w").agg(F.sort_array(F.collect_list(F.struct("r", "score", "vec_id"))).alias("ns"))
    negs = negs.select("q", (F.col("w") + 1).alias("r"), "ns")
    full = (near.select("q", "r", "score", "vec_id").join(negs, ["q", "r"], "left").groupBy("q")
            .agg(F.sort_array(F.collect_list(F.struct("r", "score", "vec_id", "ns"))).alias("ps")))

    one = number.join(full, "q").select("anchor_id", F.slice(F.filter("ps", lambda p: p["vec_id"] != F.col("anchor_id")), 1, positives).alias("ps"))
    pairs = one.select("anchor_id", F.explode("ps").alias("p")).select("anchor_id", F.col("p.vec_id").alias("positive_id"), score.alias("positive_score"),
                                                                       F.explode("p.ns").alias("n"))
    return pairs.select("anchor_id", "positive_id", F.col("n.r").alias("rank"), F.col("n.vec_id").alias("negative_id"),
                        "positive_score", F.col("n.score").alias("negative_score"))

"""Operator 9: approximate nearest neighbours by NN-descent.

Equal vectors are one node. A first graph links each node to its nearest within
blocks of ``BLOCK`` nodes, cut from ``ORDERS`` random orders (sign codes of
random planes, then a random projection). NN-descent then improves it: for each
node, the vectors of its neighbours, out and back, are joined to it, compared
with each other, and pairs that beat a node's farthest neighbour become
candidates; the nearest ``DEGREE`` stay. Rounds end when fewer than
``LEAST_NEW`` of the links are new. A query walks the graph greedily: it keeps
its ``BEAM`` nearest nodes, looks at the neighbours of those not looked at yet,
and ends when there are none, all queries a step at a time by joins.

The search is approximate by nature (recall is measured in the tests); every
vector is indexed, and lists are bounded per node, so a vector that a third of
the rows share, or a node that is everyone's neighbour, is one short list.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and those with another number of components than most,
take no part; equal vectors tie and rank by id; repeated rows with one id are
one vector's members and show up as often; null ids take no part; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import Scratch

DEGREE, BLOCK, ORDERS, ROUNDS, LEAST_NEW = 20, 256, 4, 6, 0.02
BEAM, STEPS = 160, 32
SEED = 11


def _vectors(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of equally long lists as a matrix in double precision."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows; each depends on its own row alone. Rows are scaled by
    their largest component first, so their squares neither overflow nor vanish."""
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
    norm = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
    return (x * y).sum(axis=1) / norm


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and vec of the rows that take part."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("vec") == (top.d if top else 0))


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The k best of each u's links, each pair once."""
    best = Window.partitionBy("u").orderBy(F.desc("score"), "w")
    one = edges.groupBy("u", "w").agg(F.max("score").alias("score"))
    return one.withColumn("k", F.row_number().over(best)).where(F.col("k") <= k).drop("k")


EDGE = "u long, w long, score double"


def _edge_batch(u, w, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(w, pa.int64()), pa.array(score, pa.float64())],
                                      ["u", "w", "score"])


def _first_graph(nodes: DataFrame, size: int, dim: int) -> DataFrame:
    """Links within blocks of random orders of the nodes."""
    bits = max(0, min(16, int(np.ceil(np.log2(max(size, 1) / BLOCK)))))
    planes = np.random.default_rng(SEED).normal(size=(ORDERS, bits + 1, dim))

    def place(batches):
        for batch in batches:
            x = _directions(_vectors(batch, "vec"))
            for o in range(ORDERS):
                side = x @ planes[o].T
                code = (side[:, :bits] > 0) @ (1 << np.arange(bits)) if bits else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(x), o), pa.int32()), pa.array(code, pa.int64()), pa.array(side[:, bits], pa.float64()),
                    batch.column(0), batch.column(1)], ["o", "code", "side", "node", "vec"])

    kind = dict(nodes.dtypes)["vec"]
    order = ["o", "code", "side", "node"]
    placed = nodes.select("node", "vec").mapInArrow(place, f"o int, code long, side double, node long, vec {kind}")

    def link(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids, x = part.column(0).to_numpy(), _directions(_vectors(part, "vec"))
                s = x @ x.T
                np.fill_diagonal(s, -2)
                k = min(DEGREE, len(ids) - 1)
                if k > 0:
                    near = np.argpartition(-s, k - 1, axis=1)[:, :k]
                    yield _edge_batch(np.repeat(ids, k), ids[near].ravel(), np.take_along_axis(s, near, 1).ravel())

    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("node", "vec").mapInArrow(link, EDGE)


def _around(graph: DataFrame) -> DataFrame:
    """Each node's neighbours, out and back: the nearest 2 * DEGREE."""
    return _nearest(graph.union(graph.select("w", "u", "score")), 2 * DEGREE)


def _compare(batches):
    """Compares the neighbours of a node with each other. Rows come sorted by
    node; each carries the score that a new neighbour of it has to beat."""
    held = None
    for batch in batches:
        batch = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        hub = batch.column(0).to_numpy()
        end = int(np.searchsorted(hub, hub[-1]))            # the last node's rows may go on
        held = batch.slice(end)
        if end:
            yield from _compared(batch.slice(0, end))
    if held is not None:
        yield from _compared(held)


def _compared(batch: pa.RecordBatch):
    hub, ids, least = (batch.column(k).to_numpy() for k in range(3))
    edges = np.flatnonzero(np.r_[True, hub[1:] != hub[:-1], True])
    width, step = 2 * DEGREE, 512
    for g in range(0, len(edges) - 1, step):
        cut = edges[g:g + step + 1]
        x = _directions(_vectors(batch.slice(cut[0], cut[-1] - cut[0]), "vec"))
        size, n = np.diff(cut), len(cut) - 1
        cell = (np.repeat(np.arange(n), size), np.arange(len(x)) - np.repeat(cut[:-1] - cut[0], size))
        pad, name, need = np.zeros((n, width, x.shape[1])), np.full((n, width), -1), np.full((n, width), np.inf)
        pad[cell], name[cell], need[cell] = x, ids[cut[0]:cut[-1]], least[cut[0]:cut[-1]]
        s = pad @ pad.transpose(0, 2, 1)
        s[:, np.arange(width), np.arange(width)] = -2
        s[np.broadcast_to(name[:, None, :] < 0, s.shape)] = -2
        # No node needs more than DEGREE candidates from one hub.
        top = np.argpartition(-s, DEGREE - 1, axis=2)[:, :, :DEGREE]
        score = np.take_along_axis(s, top, 2)
        i, j, k = np.nonzero((score > need[:, :, None] + 1e-9) & (score > -2))
        yield _edge_batch(name[i, j], name[i, top[i, j, k]], score[i, j, k])


def build(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """The graph over nodes (node, vec): u, w, score, the DEGREE nearest found of each."""
    size, first = nodes.count(), nodes.first()
    if size < 2:
        return nodes.sparkSession.createDataFrame([], EDGE)
    graph = scratch.write(_nearest(_first_graph(nodes, size, len(first.vec)), DEGREE), "ann-graph-0")
    for k in range(1, ROUNDS + 1):
        least = graph.groupBy("u").agg(F.when(F.count("*") >= DEGREE, F.min("score")).otherwise(F.lit(-2.0)).alias("least"))
        known = nodes.join(least, F.col("node") == F.col("u")).select("node", "least", "vec")
        hubs = (_around(graph).select(F.col("u").alias("hub"), F.col("w").alias("n")).join(known, F.col("n") == F.col("node"))
                .select("hub", "node", "least", "vec").repartition("hub").sortWithinPartitions("hub", "node"))
        new = hubs.mapInArrow(_compare, EDGE)
        nxt = scratch.write(_nearest(graph.union(new), DEGREE), f"ann-graph-{k}")
        fresh = nxt.join(graph, ["u", "w"], "left_anti").count()
        scratch.drop(graph)
        graph = nxt
        if fresh < LEAST_NEW * DEGREE * size:
            break
    return graph


def _score(batch: pa.RecordBatch) -> pa.RecordBatch:
    score = cosine(_vectors(batch, "q_vec"), _vectors(batch, "vec"))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["q", "node", "score"])


def _scored(pairs: DataFrame, nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """q, node, score of pairs (q, node)."""
    rows = pairs.join(nodes.select("node", "vec"), "node").join(
        queries.select("q", F.col("vec").alias("q_vec")), "q").select("q", "node", "q_vec", "vec")
    return rows.mapInArrow(lambda batches: map(_score, batches), "q long, node long, score double")


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, entries: DataFrame, scratch: Scratch,
           beam: int = BEAM) -> DataFrame:
    """Greedy search for queries (q, vec) from entries (q, node): q, node and
    score of the ``beam`` nearest nodes found of each query."""
    around = scratch.write(_around(graph).select(F.col("u").alias("node"), F.col("w").alias("next")), "ann-around")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    state = _scored(entries.distinct(), nodes, queries).withColumn("open", F.lit(True))
    for k in range(STEPS):
        state = scratch.write(state.withColumn("k", F.row_number().over(best)).where(F.col("k") <= beam).drop("k"), f"ann-beam-{k}")
        if not state.where("open").take(1):
            break
        # Neighbours of the open nodes that aren't in the beam; one that fell out of it scores too little again.
        found = (state.where("open").select("q", "node").join(around, "node").select("q", F.col("next").alias("node")).distinct()
                 .join(state.select("q", "node"), ["q", "node"], "left_anti"))
        state = state.withColumn("open", F.lit(False)).union(_scored(found, nodes, queries).withColumn("open", F.lit(True)))
    return state.select("q", "node", "score")


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score (cosine) of the ``k`` nearest
    found of every row for which ``is_query`` (a function of the id column)
    holds, among all rows but its own."""
    scratch = Scratch(vectors.sparkSession)
    rows = usable(vectors, id_col, vec_col).withColumn("key", F.md5(F.concat_ws(",", F.col("vec").cast("array<string>"))))
    by_id = Window.partitionBy("key").orderBy("vec_id")
    # A node's first k + 1 ids are all that a result can need of it.
    firsts = scratch.write(rows.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1), "ann-members")
    head = firsts.where("r = 1").select("key", F.col("vec_id").alias("node"), "vec")
    nodes = scratch.write(head.select("node", "vec", "key"), "ann-nodes")
    members = scratch.write(firsts.select("key", "vec_id").join(nodes.select("key", "node"), "key").select("node", "vec_id"), "ann-ids")
    asked = scratch.write(rows.where(is_query(F.col("vec_id"))).select("vec_id", "key").join(nodes.select("key", "node"), "key")
                          .select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")), "ann-queries")
    graph = build(nodes, scratch)
    queries = asked.select("q").distinct().join(nodes, F.col("q") == F.col("node")).select("q", "vec")
    start = queries.select("q", F.col("q").alias("node"))
    found = search(graph, nodes, queries, start.union(start.join(graph, F.col("q") == F.col("u")).select("q", F.col("w").alias("node"))),
                   scratch)
    first = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    found = scratch.write(found.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).drop("r"), "ann-found")
    # Of each node's ties the first ids, without the query's own.
    pairs = (asked.join(found, "q").join(members, "node").where("vec_id != query_id").select("query_id", "vec_id", "score"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

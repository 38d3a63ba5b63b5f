"""Operator 6: near-duplicate documents by BagMinHash.

A document is the multiset of its five-word shingles (lower case, words cut at
white space). On the plane of time and weight, each shingle has Poisson
processes over the dyadic weight intervals [0,1), [1,2), [2,4), ...: a point
counts for a document if its weight coordinate, found by halving the interval,
lies below the shingle's multiplicity. Each point falls on one of the
signature's slots, and a slot keeps its earliest point, so two documents agree
on a slot with a probability of exactly their weighted Jaccard similarity.
Processes are cut off at the time by which all slots are filled: a document of
n shingles costs n plus some multiples of the signature's length.

``BANDS`` bands of ``ROWS`` slots make buckets (a pair of similarity 0.8 shares
none with a probability of 5e-5). Equal multisets are one node. No bucket is
paired out. First each node is verified, on the multisets themselves, against
one pivot: of its buckets' nodes the one that most others share buckets with.
That joins large groups of copies to their original by one pair each. Then
only pairs of a bucket that are in different components still matter; those
whose sketches (512 slots) leave a link possible are verified, in one join that
gives each pair once. Links are joined to classes by alternating star
contractions.

Defined results: a text of one to four words is one shingle; a text without
words (null, empty) is a class of its own; repeated rows are members of one
class, of which ``keep_one`` keeps one row; an empty table gives an empty
table; other columns are ignored by ``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import Scratch, is_empty, map_slices

SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
SLOTS = BANDS * ROWS
#: Slots of a sketch, and how many have to agree before a pair is verified: at a similarity of 0.8 fewer do
#: with a probability of 5e-5 (0.8125 of them agree, less 3.9 standard deviations).
SKETCH_SLOTS, LEAST_ALIKE = 512, 382
#: Points that a process is carried on by at once.
STRIDE = 16

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _step(k: int) -> np.uint64:
    return np.uint64(k * int(_GOLD) & (1 << 64) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((x >> np.uint64(11)).astype(float) + 1) * 2.0 ** -53


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashes of a slice's words, each distinct one once; nothing stays in the worker."""
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash of every shingle of whole texts."""
    cut = [t.lower().split() for t in texts]
    size = np.array([len(c) for c in cut])
    words = word_hashes([w for c in cut for w in c])
    doc = np.repeat(np.arange(len(texts)), size)
    there = np.maximum(size - SHINGLE_WORDS + 1, size > 0)          # shingles of a document
    left = size[doc] - (np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size))
    first = (left >= SHINGLE_WORDS) | ((left == size[doc]) & (there[doc] > 0))
    padded = np.concatenate((words, np.zeros(SHINGLE_WORDS, np.uint64)))
    value = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE_WORDS):
        part = _mix(padded[k:k + len(words)] + _step(k + 1))
        value += np.where(left > k, part, np.uint64(k))              # a short text ends before its fifth word
    return doc[first], _mix(value[first])


def multisets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, shingle and multiplicity, by document and shingle."""
    doc, value = shingles(texts)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))


def signatures(doc: np.ndarray, value: np.ndarray, times: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """BagMinHash signatures of ``n`` multisets, a row of 64-bit values each;
    rows of empty multisets are 0."""
    weight = np.bincount(doc, times, n)
    out = np.zeros((n, slots), np.uint64)
    todo, reach = weight > 0, np.log(slots) + 4
    while todo.any():
        mine = todo[doc]
        until = slots * reach / np.maximum(weight, 1)                # of points' times
        time, name = _first_points(doc[mine], value[mine], times[mine], until, n, slots)
        full = todo & np.isfinite(time).all(axis=1)
        out[full] = name[full]
        todo &= ~full
        reach *= 2
    return out


def _first_points(doc, value, times, until, n, slots) -> tuple[np.ndarray, np.ndarray]:
    """Times and names of each slot's earliest point before ``until``."""
    time, name = np.full(n * slots, np.inf), np.zeros(n * slots, np.uint64)
    found = []
    for level in range(int(times.max(initial=1)).bit_length() + 1):
        lo = (1 << level) >> 1                                        # [0,1), [1,2), [2,4), ...
        rate = max(1, lo)
        on = np.flatnonzero(times > lo)
        if not len(on):
            break
        row, most = doc[on], times[on]
        seed = _mix(value[on] + _step(level + 1))
        at, k, width = np.zeros(len(on)), 0, 1
        while len(row):
            steps = _mix(seed[:, None] + np.arange(k + 1, k + width + 1, dtype=np.uint64) * _GOLD)
            points = at[:, None] - np.log(_unit(steps)).cumsum(axis=1) / rate
            i, j = np.nonzero(points < until[row][:, None])
            key = _mix(steps[i, j] ^ np.uint64(0xD6E8FEB86659FD93))
            # Where in the interval the point lies, by the high bits; its slot, by the low ones.
            below = lo + ((key >> np.uint64(32)) * np.uint64(rate) >> np.uint64(32)).astype(np.int64) < most[i]
            slot = (key & np.uint64(0xFFFFFFFF)) * np.uint64(slots) >> np.uint64(32)
            found.append((row[i[below]] * slots + slot[below].astype(np.int64), points[i, j][below], _mix(key[below])))
            at = points[:, -1]
            on = at < until[row]
            row, most, seed, at = row[on], most[on], seed[on], at[on]
            k, width = k + width, STRIDE
    for cell, t, _ in found:
        np.minimum.at(time, cell, t)
    for cell, t, v in found:
        first = t == time[cell]
        name[cell[first]] = v[first]
    return time.reshape(n, slots), name.reshape(n, slots)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    bands = signature.reshape(len(signature), -1, ROWS)
    key = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64) * _GOLD, bands.shape[:2]).copy()
    for k in range(ROWS):
        key = _mix(key + bands[:, :, k])
    return key.view(np.int64)


def _digests(doc, value, times, n) -> list[bytes | None]:
    """A 128-bit name of each multiset; None for empty ones."""
    edges = np.searchsorted(doc, np.arange(n + 1))
    both = np.stack((value, times.astype(np.uint64)), axis=1)
    return [hashlib.md5(both[a:b].tobytes()).digest() if b > a else None for a, b in zip(edges[:-1], edges[1:])]


def _sign(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column(2).to_pylist()
    doc, value, times = multisets(texts)
    keys = band_keys(signatures(doc, value, times, len(texts)))
    nodes = _digests(doc, value, times, len(texts))
    bands = [k if node else [] for k, node in zip(keys.tolist(), nodes)]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.binary()),
                                       pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "h", "node", "bands"])


def _members(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The multisets as sorted sets of names of (shingle, occurrence), and
    sketches of them: longer signatures of 4 bits a slot."""
    texts = batch.column(0).to_pylist()
    doc, value, times = multisets(texts)
    nodes = _digests(doc, value, times, len(texts))
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    name, owner = _mix(np.repeat(value, times) + nth.astype(np.uint64) * _GOLD), np.repeat(doc, times)
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    sets = [np.sort(name[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:])]
    four = (signatures(doc, value, times, len(texts), SKETCH_SLOTS) & np.uint64(15)).astype(np.uint8)
    sketch = (four[:, ::2] << 4 | four[:, 1::2]).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary()),
                                       pa.array(list(sketch), pa.list_(pa.int64()))], ["node", "members", "sketch"])


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two multisets as ``_members`` writes them."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


def _verify(batch: pa.RecordBatch) -> pa.RecordBatch:
    score = [overlap(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64())], ["a", "b", "score"])


def _alike() -> Column:
    """How many slots of two sketches (a_sketch, b_sketch) hold equal 4-bit values."""
    low = F.lit(0x1111111111111111)
    total = F.lit(0)
    for k in range(SKETCH_SLOTS // 16):
        x = F.col("a_sketch")[k].bitwiseXOR(F.col("b_sketch")[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total = total + F.bit_count(x.bitwiseAND(low))
    return F.lit(SKETCH_SLOTS) - total


class _Search:
    """The search for links among one table's signatures."""

    def __init__(self, texts: DataFrame, signed: DataFrame, scratch: Scratch):
        self.scratch = scratch
        self.nodes = scratch.write(signed.where("node is not null").groupBy("node").agg(F.first("bands").alias("bands")),
                                   "near-nodes")
        keys = self.nodes.select("node", F.posexplode("bands").alias("band", "key"))
        sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        self.rows = scratch.write(keys.join(sizes, "key"), "near-buckets")
        # Multisets of the nodes that share a bucket, each from one of its rows.
        some = signed.join(self.rows.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
            F.min(F.struct("doc_id", "h")).alias("row")).select(F.col("row.doc_id").alias("d"), F.col("row.h").alias("rh"))
        here = texts.join(some, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("rh"))).select("text")
        self.members = scratch.write(
            map_slices(here, _members, "node binary, members binary, sketch array<long>").dropDuplicates(["node"]), "near-members")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Similarities of distinct pairs (a, b)."""
        m = self.members
        both = (pairs.join(m.select(F.col("node").alias("a"), F.col("members").alias("x")), "a")
                .join(m.select(F.col("node").alias("b"), F.col("members").alias("y")), "b").select("a", "b", "x", "y"))
        return map_slices(both, _verify, "a binary, b binary, score double")

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that are similar, written."""
        return self.scratch.write(self.verify(pairs).where(F.col("score") >= SIMILARITY).select("a", "b"), name)

    def to_pivots(self) -> DataFrame:
        """A pair for each node: with the pivot of its buckets that most nodes
        share buckets with, an original rather than one of its copies."""
        fame = self.rows.groupBy("node").agg(F.sum("n").alias("fame"))
        known = self.rows.select("key", "node").join(fame, "node")
        pivots = known.groupBy("key").agg(F.max(F.struct("fame", "node")).alias("p"))
        best = (self.rows.select("key", "node").join(pivots, "key").where(F.col("node") != F.col("p.node"))
                .groupBy("node").agg(F.max("p").alias("p")))
        return best.select(F.col("node").alias("a"), F.col("p.node").alias("b"))

    def between(self, label: DataFrame) -> DataFrame:
        """All pairs of a bucket in different components whose sketches don't
        rule a link out, each in the first bucket that it shares."""
        rows = self.rows.select("key", "band", "node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        rows = self.scratch.write(rows, "near-labelled")
        # Buckets of one component are done; in the others, the largest component is on one side only.
        main = (rows.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key")
                .agg(F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
                .select("key", F.col("main.label").alias("main")))
        open_rows = rows.join(main, "key")
        sketches = self.members.select("node", "sketch").join(self.nodes, "node")
        full = self.scratch.write(open_rows.join(sketches, "node"), "near-open")
        a = full.where(F.col("label") != F.col("main")).select("key", "band", *(
            F.col(c).alias(f"a_{c}") for c in ("node", "label", "bands", "sketch")))
        b = full.select("key", "main", *(F.col(c).alias(f"b_{c}") for c in ("node", "label", "bands", "sketch")))
        same = F.zip_with("a_bands", "b_bands", lambda x, y: x == y)
        once = (F.col("b_label") == F.col("main")) | (F.col("a_node") < F.col("b_node"))
        near = (F.col("a_label") != F.col("b_label")) & once & (_alike() >= LEAST_ALIKE)
        first = F.array_position(same, F.lit(True)) == F.col("band") + 1
        joined = a.join(b, (a.key == b.key) & near & first)
        return joined.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label (the smallest node of its component) of every linked node,
    by alternating large and small stars until nothing changes."""
    edges = scratch.write(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-links")
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours go to the smallest of all; small star: smaller ones do.
        large = scratch.write(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                              .where("u != v").distinct(), "near-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        nxt = scratch.write(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "near-small")
        same = nxt.join(edges, ["u", "v"], "left_anti")
        if is_empty(same) and nxt.count() == edges.count():
            break
        edges = nxt
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()


def _row_hash(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, h (its hash), class_id (the
    smallest id of its class), class_size, wordless and kept (true for the row
    that stays, and for its repeats)."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), _row_hash(id_col, text_col).alias("h"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    signed = scratch.write(map_slices(texts, _sign, "doc_id long, h long, node binary, bands array<long>"), "near-signed")
    search = _Search(texts, signed, scratch)
    links = search.links(search.to_pivots(), "near-links")
    label = scratch.write(components(links, scratch), "near-label")
    late = search.links(search.between(label), "near-late")
    if not is_empty(late):
        label = scratch.write(components(links.union(late), scratch), "near-label")
    rows = signed.select("doc_id", "h", "node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("first")
    found = (rows.where("label is not null").groupBy("label").agg(F.count("*").alias("n"), first)
             .select(F.col("label").alias("c"), "n", F.col("first.doc_id").alias("class_id"), F.col("first.h").alias("class_h")))
    alone = F.col("c").isNull()
    return rows.join(found, F.col("label") == F.col("c"), "left").select(
        "doc_id", "h", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("n")).alias("class_size"),
        F.col("node").isNull().alias("wordless"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("h") == F.col("class_h")))).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: one of each class."""
    tag = f"_{uuid.uuid4().hex[:8]}"
    keys = (classes(docs, id_col, text_col).where("kept").groupBy("doc_id", "h")
            .agg(F.when(F.first("wordless"), 1).otherwise(F.count("*")).alias(f"{tag}n"))
            .withColumnsRenamed({"doc_id": f"{tag}i", "h": f"{tag}h"}))
    rows = docs.withColumn(f"{tag}r", _row_hash(id_col, text_col)).join(
        keys, F.col(id_col).cast("long").eqNullSafe(F.col(f"{tag}i")) & (F.col(f"{tag}r") == F.col(f"{tag}h")))
    one = Window.partitionBy(f"{tag}i", f"{tag}h").orderBy(F.lit(1))
    repeats = (rows.where(F.col(f"{tag}n") > 1).withColumn(f"{tag}k", F.row_number().over(one))
               .where(F.col(f"{tag}k") == 1))
    return rows.where(F.col(f"{tag}n") == 1).select(docs.columns).unionAll(repeats.select(docs.columns))

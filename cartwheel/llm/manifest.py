"""Operator 12: Merkle dataset manifest.

Every row is a leaf; the leaves of a source, in id order, form a tree of 16
children a node, and the sources' roots, in the order of their names, form
another. The method is a nested-struct rollup. A leaf's rank in its source is
written in base 16; ``groupBy`` takes away the last digit, nesting the children
of a node as structs, then the next, up to ``BLOCK_LEVELS`` digits. So a block
is one row of at most 16 ** BLOCK_LEVELS leaves, whatever the size of the
source, and all its levels are built behind one shuffle. Blocks are the leaves
of the next tier, until one node is left. Proofs come back down: ``transform``
gives each child what lies left and right of it, ``explode`` deals the children
out, with no join inside a block. One join a tier hands each block the path
above it: a row a block.

Ranks come from a range partitioning by (source, id), so a source with a third
of all rows is ranked and rolled up by many tasks.

Defined results: nulls in hashed columns are hashed as ``-``; a null source is
a source of its own, before all others; null ids come before all others of
their source; rows of one id are ordered by their leaf, so repeated rows are
leaves side by side (their order makes no difference); empty texts hash as
``0:``; long texts are hashed where they are read and never shuffled; an empty
table gives an empty table; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.ranking import global_row_number
from cartwheel.llm.common import Scratch, is_empty

#: Children of a node are told apart by so many bits of their rank.
FAN_BITS = 4
#: Levels of a block: a row nests at most 16 ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 3
#: Sources up to which their positions are broadcast; more are joined by a shuffle.
FEW_SOURCES = 10_000
HASHED = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 (hex) of the fields, each ``-`` or its UTF-8 byte count, ``:`` and it."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*map(part, fields)), 256)


def _depth(n: Column) -> Column:
    """Levels over n nodes: the powers of 16 below n."""
    return sum((F.when(n > (1 << FAN_BITS * k), 1).otherwise(0) for k in range(15)), F.lit(0)).cast("int")


def _digit(rank: Column, k: int) -> Column:
    return F.shiftright(rank, FAN_BITS * k).bitwiseAND(F.lit((1 << FAN_BITS) - 1)).cast("int")


def _joined(kids: Column) -> Column:
    """H of a run: the SHA-256 of its digests, concatenated as text."""
    return F.sha2(F.concat_ws("", F.transform(kids, lambda k: k["digest"])), 256)


@dataclass
class Tier:
    """Blocks of one tree's nodes: tree, depth, block, digest and their nested
    children; ``done`` levels lie below."""

    rows: DataFrame
    done: int

    def finished(self) -> Column:
        """Trees that end in this tier: their digest is the tree's root."""
        return F.col("depth") <= self.done + BLOCK_LEVELS


def _roll_up(nodes: DataFrame, done: int, carry: list[str], scratch: Scratch) -> Tier:
    """Nests nodes (tree, depth, rank, digest and carried columns) into blocks."""
    rows = (nodes.withColumn("block", F.shiftright("rank", FAN_BITS * BLOCK_LEVELS))
            .withColumns({f"d{k}": _digit(F.col("rank"), k) for k in range(BLOCK_LEVELS)})
            .repartition("tree", "block"))
    inside = ["digest", *carry]
    for k in range(BLOCK_LEVELS):
        keys = ["tree", "depth", "block", *(f"d{j}" for j in reversed(range(k + 1, BLOCK_LEVELS)))]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{k}").alias("at"), *inside))).alias("kids")
        rows = rows.groupBy(*keys).agg(kids).withColumn(
            "digest", F.when(F.col("depth") > done + k, _joined(F.col("kids"))).otherwise(F.col("kids")[0]["digest"]))
        inside = ["digest", "kids"]
    return Tier(scratch.write(rows, f"manifest-tier-{done}"), done)


def _tiers(nodes: DataFrame, carry: list[str], deepest: int, scratch: Scratch) -> list[Tier]:
    tiers = [_roll_up(nodes, 0, carry, scratch)]
    while deepest > (done := len(tiers) * BLOCK_LEVELS):
        last = tiers[-1]
        above = last.rows.where(~last.finished()).select("tree", "depth", F.col("block").alias("rank"), "digest")
        tiers.append(_roll_up(above, done, [], scratch))
    return tiers


def _roots(tiers: list[Tier]) -> DataFrame:
    """tree and its root."""
    found = [t.rows.where(t.finished()).select("tree", F.col("digest").alias("tree_root")) for t in tiers]
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _sides(kids: Column) -> Column:
    """The children, each with its siblings' digests to the left and right."""
    digests = F.transform(kids, lambda k: k["digest"])
    return F.transform(kids, lambda k, i: F.struct(
        k.alias("kid"), F.struct(F.concat_ws("", F.slice(digests, F.lit(1), i)).alias("left"),
                                 F.concat_ws("", F.slice(digests, i + 2, F.lit(1 << FAN_BITS))).alias("right")).alias("side")))


def _deal_out(tier: Tier, paths: DataFrame, carry: list[str]) -> DataFrame:
    """A row a node below the tier: tree, rank, digest, carried columns, path
    (siblings level by level up to the root) and tree_root; ``paths`` holds
    (tree, block, path, tree_root) of the tier's blocks."""
    rows = tier.rows.join(paths, ["tree", "block"]).withColumn("rank", F.col("block"))
    for k in reversed(range(BLOCK_LEVELS)):
        rows = rows.withColumn("one", F.explode(_sides(F.col("kids")))).drop("kids", "digest")
        path = F.when(F.col("depth") > tier.done + k, F.concat(F.array("one.side"), "path")).otherwise(F.col("path"))
        inside = ["kids", "digest"] if k else ["digest", *carry]
        rows = rows.select("tree", "depth", "tree_root", (F.shiftleft("rank", FAN_BITS) + F.col("one.kid.at")).alias("rank"),
                           path.alias("path"), *(F.col(f"one.kid.{c}").alias(c) for c in inside))
    return rows


def _paths_down(tiers: list[Tier], tops: DataFrame, carry: list[str]) -> DataFrame:
    """The nodes below the lowest tier with their paths; ``tops``: tree, path, tree_root."""
    ended = tops.withColumn("block", F.lit(0).cast("long"))
    rows = None
    for tier in reversed(tiers):
        known = ended.join(tier.rows.where(tier.finished()).select("tree"), "tree", "left_semi") if len(tiers) > 1 else ended
        known = known.select("tree", "block", "path", "tree_root")
        if rows is not None:
            known = known.unionAll(rows.select("tree", F.col("rank").alias("block"), "path", "tree_root"))
        rows = _deal_out(tier, known, carry if tier is tiers[0] else [])
    return rows


EMPTY_PATH = "array<struct<left:string,right:string>>"


def manifest(docs: DataFrame, columns: tuple = HASHED, id_col: str = "doc_id", source_col: str = "source",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """A row for each row of ``docs``: doc_id, leaf, subroot, root and path, the
    siblings (left, right) of the leaf and of every node above it; columns of
    ``carry``, computed where the row is read, come along."""
    scratch, spark = Scratch(docs.sparkSession), docs.sparkSession
    carry = carry or {}
    names = [f"x{k}" for k in range(len(carry))]
    leaves = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                         leaf_hash(*(F.col(c) for c in columns)).alias("digest"),
                         *(c.alias(n) for n, c in zip(names, carry.values(), strict=True)))
    leaves = scratch.write(leaves, "manifest-leaves")
    schema = [F.col("doc_id"), F.lit("").alias("leaf"), F.lit("").alias("subroot"), F.lit("").alias("root"),
              F.array().cast(EMPTY_PATH).alias("path"), *(F.col(n).alias(o) for n, o in zip(names, carry, strict=True))]
    if is_empty(leaves):
        return leaves.select(*schema)
    # The place in the table is the last key: equal rows spread over partitions as any others.
    at = leaves.withColumn("at", F.monotonically_increasing_id())
    ranked = global_row_number(at, ["source", "doc_id", "digest", "at"], "grn").drop("at")
    starts = scratch.write(ranked.groupBy("source").agg(F.min("grn").alias("tree"), F.count("*").alias("n")), "manifest-sources")
    trees = starts.select(F.col("source").alias("s"), "tree", _depth(F.col("n")).alias("depth"))
    few = starts.agg(F.count("*").alias("n"), F.max("n").alias("most"), F.sum(F.octet_length("source")).alias("bytes")).first()
    if few.n <= FEW_SOURCES and (few.bytes or 0) <= 100 * FEW_SOURCES:
        trees = F.broadcast(trees)
    # A source is named by the position of its first leaf: positions are in the order of the sources.
    nodes = ranked.join(trees, ranked["source"].eqNullSafe(trees["s"])).select(
        "tree", "depth", (F.col("grn") - F.col("tree")).alias("rank"), "doc_id", "digest", *names)
    deepest = sum(few.most > (1 << FAN_BITS * k) for k in range(15))
    tiers = _tiers(nodes, ["doc_id", *names], deepest, scratch)

    subroots = scratch.write(_roots(tiers), "manifest-subroots")
    over = global_row_number(subroots, ["tree"], "grn").select(
        F.lit(0).cast("long").alias("tree"), F.lit(sum(few.n > (1 << FAN_BITS * k) for k in range(15))).cast("int").alias("depth"),
        (F.col("grn") - 1).alias("rank"), F.col("tree_root").alias("digest"), F.col("tree").alias("of"))
    top = _tiers(over, ["of"], sum(few.n > (1 << FAN_BITS * k) for k in range(15)), scratch)
    root = _roots(top).first()["tree_root"]
    one = spark.range(1).select(F.col("id").alias("tree"), F.array().cast(EMPTY_PATH).alias("path"),
                                F.lit(root).alias("tree_root"))
    sources = _paths_down(top, one, ["of"]).select(F.col("of").alias("tree"), "path", F.col("digest").alias("tree_root"))
    rows = _paths_down(tiers, scratch.write(sources, "manifest-paths"), ["doc_id", *names])
    return rows.select("doc_id", F.col("digest").alias("leaf"), F.col("tree_root").alias("subroot"), F.lit(root).alias("root"),
                       "path", *(F.col(n).alias(o) for n, o in zip(names, carry, strict=True)))


def proof_hash(path: Column) -> Column:
    """SHA-256 (hex) of all siblings of a path, left to right, level by level."""
    return F.sha2(F.concat_ws("", F.flatten(F.transform(path, lambda p: F.array(p["left"], p["right"])))), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))

"""Operator 5: mixing sources to target weights, by DataFrame functions alone.

Each source's documents, permuted by hash, lie on a line of words that is as
long as the source's target; past its end the line starts over (at most twice
through the source). The line is cut into blocks of ``block_words``. A
splitting tree halves the output shards again and again: at each node the
source quotas, in blocks, are split by a multivariate-hypergeometric draw, so
every shard gets an exact number of blocks of each source, as if all blocks had
been shuffled and dealt. Shards draw disjoint runs of the source's permuted
blocks and order their rows by hash.

Only whole documents are taken: those that end on the line, then others until
no copy left fits into what its source lacks. Each round lays the copies left of
at most half the lack on the rest of the line, in the same order; it halves the
lack or takes them all. Where none is that small, one more fits at most: the
largest that does. The line positions come from running sums over hash buckets
(a bucket has about ``BUCKET_ROWS`` rows, however large its source).

The plan's driver side is a row per source (``MAX_SOURCES`` at most, else an
error) and a cell per source and shard.

Defined results: a null text has size 0; null is a source of its own, last in
order; documents of size 0 are taken 0 words and, in ``mixed``, no row; repeated
rows are documents of their own; an empty table gives an empty table; other
columns are ignored by ``plan`` and kept by ``mixed``.
"""

from __future__ import annotations

import json
import math
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import Scratch

#: Sources that a mix can name; shards of its output; words of a block.
MAX_SOURCES, SHARDS, BLOCK_WORDS = 100_000, 16, 1 << 14
BUCKET_ROWS = 4096
#: Bytes of a part of an output shard, about, and bytes of a word.
PART_BYTES, WORD_BYTES = 4 << 20, 8
#: Weights by a source's place in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix's size as a share of all words, and how often a source may be repeated.
TOTAL_SHARE, MAX_REPEAT = 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], total: float, max_repeat: float = MAX_REPEAT) -> list[float]:
    """Shares of ``total`` by weight, none above ``max_repeat`` times its
    source's size: what is above goes to the others by weight, again and again."""
    out, fixed = [0.0] * len(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest = total - sum(out[i] for i in fixed)
        unit = rest / w if (w := sum(weights[i] for i in free)) else 0.0
        for i in free:
            out[i] = unit * weights[i]
        over = [i for i in free if out[i] > max_repeat * sizes[i]]
        for i in over:
            out[i] = float(max_repeat * sizes[i])
        if not over:
            return out
        fixed.update(over)


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (row) in each shard (column): the leaves of a tree
    whose nodes split their quotas between two halves of their shards."""
    out, rng = np.zeros((len(quotas), shards), np.int64), np.random.default_rng(seed)
    nodes = [(np.array(quotas, np.int64), 0, shards)]
    while nodes:
        own, lo, hi = nodes.pop()
        if hi - lo == 1:
            out[:, lo] = own
            continue
        mid = (lo + hi) // 2
        share = int(own.sum()) * (mid - lo) // (hi - lo)
        left, rest, need = np.zeros_like(own), int(own.sum()), share
        for i, q in enumerate(own.tolist()):                # one source after another: each a hypergeometric draw
            rest -= q
            left[i] = rng.hypergeometric(q, rest, need) if q and need else 0
            need -= int(left[i])
        nodes += [(left, lo, mid), (own - left, mid, hi)]
    return out


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from plan values."""
    text = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(text))


def _narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), text).alias("h"))


def plan(docs: DataFrame, weights: tuple = WEIGHTS, total_share: float = TOTAL_SHARE, shards: int = SHARDS,
         block_words: int = BLOCK_WORDS, seed: int = 20, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """A row for each document: doc_id, source, h (its hash), size, source_size,
    target, taken (words) and shards (the shard of each copy taken)."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    narrow = scratch.write(_narrow(docs, id_col, text_col, source_col, seed), "mix-rows")
    found = narrow.groupBy("source").agg(F.sum("size").alias("s"), F.count("*").alias("n")).take(MAX_SOURCES + 1)
    if len(found) > MAX_SOURCES:
        raise ValueError(f"a mix can name {MAX_SOURCES} sources at most")
    # Code-point order, null last.
    found.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    sizes = [r.s for r in found]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], total_share * sum(sizes))
    blocks = [max(1, math.ceil(t / block_words)) for t in goal]
    quotas = split_quotas(blocks, shards, seed).cumsum(axis=1)
    rng = np.random.default_rng(seed + 1)
    steps = [next(a for a in rng.integers(1, n + 1, 10_000).tolist() if math.gcd(a, n) == 1) for n in blocks]
    # Bounded by MAX_SOURCES: a row for each source, with its shards' last blocks.
    sources = F.broadcast(_rows(spark, [
        {"s_key": json.dumps(r.source), "s_no": i, "source_size": sizes[i], "target": goal[i], "n_blocks": blocks[i],
         "step": steps[i], "ends": quotas[i].tolist()} for i, r in enumerate(found)],
        "s_key: string, s_no: int, source_size: long, target: double, n_blocks: long, step: long, ends: array<long>"))
    names = F.broadcast(_rows(spark, [{"s_name": r.source, "s_no": i} for i, r in enumerate(found)], "s_name: string, s_no: int"))

    # Position on the line: words of the source's earlier buckets, then of earlier rows in the bucket.
    bits = max(4, math.ceil(math.log2(max(sum(r.n for r in found), 1) / BUCKET_ROWS + 1)))
    rows = (narrow.join(names, F.col("source").eqNullSafe(F.col("s_name"))).drop("s_name")
            .withColumn("bucket", F.shiftrightunsigned("h", 64 - bits)))
    sums = rows.groupBy("s_no", "bucket").agg(F.sum("size").alias("words"))
    ahead = sums.select("s_no", "bucket", (F.sum("words").over(Window.partitionBy("s_no").orderBy("bucket"))
                                           - F.col("words")).alias("ahead"))
    inside = Window.partitionBy("s_no", "bucket").orderBy("h", "doc_id", "size")
    rows = (rows.withColumns({"place": F.row_number().over(inside),
                              "before": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")})
            .join(ahead, ["s_no", "bucket"]).withColumn("at", F.col("ahead") + F.col("before")))
    fits = [(F.col("at") + F.col("size") + k * F.col("source_size") <= F.col("target")).cast("int") for k in range(MAX_REPEAT)]
    units = scratch.write(rows.join(sources, "s_no").withColumn("copies", F.when(F.col("size") > 0, sum(fits[1:], fits[0])).otherwise(0))
                          .select("doc_id", "source", "h", "size", "s_no", "bucket", "place", "at", "copies"), "mix-units")
    extra = _fill(scratch, units, goal)
    # The copies of a document lie in blocks of the line; a shard's run of permuted blocks ends at its entry of ends.
    first = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>"))
    spots = F.concat(F.transform(first, lambda k: F.col("at") + k * F.col("source_size")),
                     F.coalesce("spots", F.array().cast("array<long>")))

    def shard(spot):
        block = F.least(F.floor(spot / block_words), F.col("n_blocks") - 1)
        place = F.pmod(block * F.col("step"), F.col("n_blocks"))
        return F.size(F.filter("ends", lambda end: end <= place))

    out = units.join(extra, ["s_no", "bucket", "place"], "left").join(sources, "s_no").withColumn("spots", spots)
    return out.select("doc_id", "source", "h", "size", "source_size", "target",
                      (F.size("spots") * F.col("size")).alias("taken"), F.transform("spots", shard).alias("shards"))


def _fill(scratch: Scratch, units: DataFrame, goal: list[float]) -> DataFrame:
    """Copies taken besides those on the line, until none left fits into what
    its source lacks: s_no, bucket, place and spots (where on the rest of the
    line each copy starts). The driver holds a row for each source."""
    spark = scratch.spark
    got = {r.s_no: r.t for r in units.groupBy("s_no").agg(F.sum(F.col("copies") * F.col("size")).alias("t")).collect()}
    lacks, left, last, laid = {s: goal[s] - t for s, t in got.items()}, units, [], []
    while lacks:
        lack = F.broadcast(_rows(spark, [{"l_no": s, "lack": x, "start": int(got[s])} for s, x in lacks.items()],
                                 "l_no: int, lack: double, start: long"))
        left = (left.join(lack, F.col("s_no") == F.col("l_no")).drop("l_no")
                .where((F.col("size") > 0) & (F.col("size") <= F.col("lack")) & (F.col("copies") < MAX_REPEAT)))
        found = left.groupBy("s_no").agg(F.min("size").alias("least"), F.max(F.struct("size", "bucket", "place")).alias("b")).collect()
        last += [{"s_no": r.s_no, "bucket": r.b.bucket, "place": r.b.place, "spots": [int(got[r.s_no])]}
                 for r in found if 2 * r.least > lacks[r.s_no]]
        lacks = {r.s_no: lacks[r.s_no] for r in found if 2 * r.least <= lacks[r.s_no]}
        if not lacks:
            break
        more = F.broadcast(_rows(spark, [{"m_no": s} for s in lacks], "m_no: int"))
        now = scratch.write(_lay(left.join(more, F.col("s_no") == F.col("m_no"), "left_semi")), "mix-fill")
        laid.append(now.where(F.size("spots") > 0).select("s_no", "bucket", "place", "spots"))
        for r in now.groupBy("s_no").agg(F.sum(F.size("spots") * F.col("size")).alias("t")).collect():
            got[r.s_no] += r.t
            lacks[r.s_no] -= r.t
        left = now.select("s_no", "bucket", "place", "size", (F.col("copies") + F.size("spots")).alias("copies"))
    out = _rows(spark, last, "s_no: int, bucket: long, place: int, spots: array<long>")
    for one in laid:
        out = out.unionByName(one)
    return out.groupBy("s_no", "bucket", "place").agg(F.flatten(F.collect_list("spots")).alias("spots"))


def _lay(left: DataFrame) -> DataFrame:
    """One round: the copies left of at most half the lack, one of each document
    and then the second ones, on a line as long as the lack. Adds spots."""
    laps = [F.when((2 * F.col("size") <= F.col("lack")) & (F.col("copies") + k < MAX_REPEAT), F.col("size")).otherwise(0)
            for k in range(MAX_REPEAT)]
    rows = left.select("s_no", "bucket", "place", "size", "copies", "lack", "start", *[x.alias(f"lap{k}") for k, x in enumerate(laps)])
    buckets = rows.groupBy("s_no", "bucket").agg(*[F.sum(f"lap{k}").alias(f"sum{k}") for k in range(MAX_REPEAT)])
    line, whole = Window.partitionBy("s_no").orderBy("bucket"), Window.partitionBy("s_no")
    ahead = buckets.select("s_no", "bucket", *[
        (sum((F.sum(f"sum{j}").over(whole) for j in range(k)), F.sum(f"sum{k}").over(line)) - F.col(f"sum{k}")).alias(f"ahead{k}")
        for k in range(MAX_REPEAT)])
    inside = Window.partitionBy("s_no", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = (rows.withColumns({f"end{k}": F.sum(f"lap{k}").over(inside) for k in range(MAX_REPEAT)})
            .join(ahead, ["s_no", "bucket"]).withColumns({f"end{k}": F.col(f"ahead{k}") + F.col(f"end{k}") for k in range(MAX_REPEAT)}))
    spots = F.array_compact(F.array(*[
        F.when((F.col(f"lap{k}") > 0) & (F.col(f"end{k}") <= F.col("lack")), F.col("start") + F.col(f"end{k}") - F.col("size"))
        for k in range(MAX_REPEAT)]))
    return rows.select("s_no", "bucket", "place", "size", "copies", spots.alias("spots"))


def mixed(docs: DataFrame, seed: int = 20, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, with all their columns, as often as
    they are taken, dealt to the shards and shuffled within them."""
    tag = f"_{uuid.uuid4().hex[:8]}"
    p, s, h, m, r = (f"{tag}{c}" for c in "pshmr")
    chosen = Scratch(docs.sparkSession).write(
        plan(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **options)
        .groupBy("doc_id", "source", "h").agg(F.flatten(F.collect_list("shards")).alias(s), F.count("*").alias(m),
                                              F.sum("taken").alias("words"))
        .where(F.size(s) > 0), "mix-chosen")
    # A shard is as many parts as its bytes ask for, dealt by hash: what meets in a task doesn't grow with the mix.
    words = chosen.agg(F.sum("words")).first()[0] or 0
    parts = max(1, words * WORD_BYTES // (options.get("shards", SHARDS) * PART_BYTES))
    chosen = chosen.drop("words")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    here = docs.withColumns({h: F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), text)})
    keys = chosen.withColumnsRenamed({"doc_id": f"{tag}i", "source": f"{tag}o", "h": p})
    rows = here.join(keys, (F.col(h) == F.col(p)) & F.col(id_col).cast("long").eqNullSafe(F.col(f"{tag}i"))
                     & F.col(source_col).cast("string").eqNullSafe(F.col(f"{tag}o")))
    # Repeated rows share what their key takes: the k-th of them every m-th copy.
    one = Window.partitionBy(p, f"{tag}i", f"{tag}o").orderBy(F.lit(1))
    alone = rows.where(F.col(m) == 1).withColumn(r, F.lit(1))
    repeats = rows.where(F.col(m) > 1).withColumn(r, F.row_number().over(one))
    dealt = alone.unionByName(repeats).withColumn(s, F.filter(s, lambda x, k: F.pmod(k, F.col(m)) == F.col(r) - 1))
    out = dealt.select(*docs.columns, F.posexplode(s).alias(f"{tag}k", f"{tag}shard"), F.col(h))
    return (out.repartition(f"{tag}shard", F.pmod(F.xxhash64(h, f"{tag}k"), F.lit(int(parts)))).sortWithinPartitions(f"{tag}shard", F.xxhash64(h, f"{tag}k"))
            .select(docs.columns))

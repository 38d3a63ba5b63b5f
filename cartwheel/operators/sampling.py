"""Negative sampling, user samples and folds: N1-N10, F12, F17.

Random draws are defined as "order by ``md5(concat_ws('_', user_id, item_id,
seed))``, take n": exact n, repeatable under any partitioning, and
reproducible in SQL. All cuts of one operator (classes, recency buckets) come
from one radix selection: counts by hash prefix, the keys at the edges, then a
filter on the wide rows, which are neither sorted nor written
(``functions.selection``).
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import bucket_index, hash_bucket, hash_order
from cartwheel.functions.ranking import row_number_within
from cartwheel.functions.selection import CELL_ROWS, first_of_groups, prefix, rank_cells
from cartwheel.session import materialize

GAP = "ui_days_since_last_action"


def _key(seed: int) -> Column:
    return hash_order(seed, "user_id", "item_id")


def _then(df: DataFrame) -> list[str]:
    # Repeats of an item in P differ by category, where rows have one: with it the order is total.
    return ["user_id", "item_id", *(c for c in df.columns if c == "item_category")]


#: Groups of a selection among labelled rows: positives and eligible negatives.
POS, NEG = -1, 0


def downsample_negatives(df: DataFrame, neg_pos_ratio: float = 20, seed: int = 42,
                         neg_max_gap_days: int | None = None, by_user: bool = False) -> DataFrame:
    """All positives plus ``min(#neg, int(#pos * ratio))`` negatives.

    F12: with ``neg_max_gap_days`` only negatives with a gap <= it are eligible.
    If either class is empty (also after the gap filter) the input comes back
    unchanged (Q7).
    """
    neg_cond = F.col("label") == 0
    if neg_max_gap_days is not None and GAP in df.columns:
        neg_cond = neg_cond & (F.col(GAP) <= F.lit(int(neg_max_gap_days)))
    group = F.when(F.col("label") == 1, POS).when(neg_cond, NEG)

    def quotas(n: dict) -> dict:
        return {g: n[g] if g == POS else min(n[NEG], int(n[POS] * neg_pos_ratio)) for g in n} if len(n) == 2 else {}

    if not by_user:
        cut = first_of_groups(df, group, _key(seed), _then(df), quotas)
        return cut.of(df) if len(cut.totals) == 2 else df
    n = {r["g"]: r["c"] for r in df.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("c")).where("g IS NOT NULL").collect()}
    if len(n) < 2:
        return df
    return df.where(group == POS).unionByName(_by_user(df.where(group == NEG), n[NEG], quotas(n)[NEG], seed))


def _by_user(neg: DataFrame, n_neg: int, target: int, seed: int) -> DataFrame:
    """Per user ``round_half_even(cnt / #neg * target)`` (0 skipped, capped at
    cnt); a total above target is cut to target; nothing allocated -> N1.

    A user's rows are ranked in cells of their hash prefix, so a user with a
    third of the rows is ranked by many tasks; the cells' counts give each cell
    what it has to deliver."""
    key, then = _key(seed), _then(neg)
    counts = neg.groupBy("user_id").agg(F.count(F.lit(1)).alias("_cnt"))
    take = F.bround(F.col("_cnt").cast("double") / F.lit(float(n_neg)) * F.lit(float(target)), 0).cast("bigint")
    alloc = counts.select("user_id", F.least(take, F.col("_cnt")).alias("_take"),
                          F.when(F.col("_cnt") > CELL_ROWS, 256).otherwise(1).alias("_cells")).where(F.col("_take") > 0)
    alloc = materialize(alloc, "user-shares")
    marked = neg.join(alloc, "user_id").withColumn("_k", key)
    # Equal shares of the hash: cell c of a heavy user holds its c-th 256th.
    marked = marked.withColumn("_c", F.floor(prefix(F.col("_k")) * F.col("_cells") / F.lit(16 ** 4)).cast("int"))
    heavy = alloc.where("_cells > 1")
    ranked = marked.withColumn("_r", F.row_number().over(Window.partitionBy("user_id", "_c").orderBy("_k", *then)))
    if heavy.limit(1).count():
        cells = marked.where("_cells > 1").groupBy("user_id", "_c").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy("user_id").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
        bases = cells.select("user_id", "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
        ranked = ranked.join(bases, ["user_id", "_c"], "left").withColumn("_r", F.col("_r") + F.coalesce("_base", F.lit(0)))
    picked = ranked.where(F.col("_r") <= F.col("_take")).select(*neg.columns)
    picked = materialize(picked, "user-picks")              # of the size of the result
    cut = first_of_groups(picked, F.lit(NEG), key, then, lambda n: {g: target for g in n})
    if not cut.totals:
        return first_of_groups(neg, F.lit(NEG), key, then, lambda n: {g: target for g in n}).of(neg)
    return cut.of(picked)


def downsample_negatives_bucketed(df: DataFrame, neg_pos_ratio: float = 20,
                                  bounds: Sequence[int] = (1, 3, 7), seed: int = 42) -> DataFrame:
    """Negatives drawn per recency bucket of the pair gap, ``int(#pos_b * ratio)``
    from each bucket that has positives (none from buckets without positives).

    Input unchanged when a class is empty or the gap column is missing;
    nothing drawn at all -> N1. All buckets are cut by one selection.
    """
    if GAP not in df.columns:
        return df
    label = F.col("label")
    group = F.when(label.isin(0, 1), 2 * bucket_index(GAP, bounds) + label)       # even: negatives

    def quotas(n: dict) -> dict:
        share = {g - 1: int(n[g] * neg_pos_ratio) for g in n if g % 2}
        return {g: n[g] if g % 2 else min(share.get(g, 0), n[g]) for g in n}

    cut = first_of_groups(df, group, _key(seed), _then(df), quotas)
    if len({g % 2 for g in cut.totals}) < 2:
        return df
    if not any(q for g, q in quotas(cut.totals).items() if g % 2 == 0):
        return downsample_negatives(df, neg_pos_ratio=neg_pos_ratio, seed=seed)
    return cut.of(df)


def downsample_chained(df: DataFrame, neg_pos_ratio: float = 20, neg_max_gap_days: int | None = None,
                       bounds: Sequence[int] = (1, 3, 7), seed: int = 42) -> DataFrame:
    """N1 with the gap filter, then N3 on its output."""
    base = downsample_negatives(df, neg_pos_ratio=neg_pos_ratio, seed=seed, neg_max_gap_days=neg_max_gap_days)
    return downsample_negatives_bucketed(base, neg_pos_ratio=neg_pos_ratio, bounds=bounds, seed=seed)


def sample_size(n_users: int, frac: float, floor: int = 0) -> int:
    return min(n_users, max(floor, 1, int(n_users * frac)))


def user_sample(df: DataFrame, frac: float, seed: int = 42, floor: int = 0) -> DataFrame:
    """N6 + J14: ``min(#users, max(floor, 1, int(#users * frac)))`` users, all
    their rows (the original's setting: a share of 0.02, a floor of 20000)."""
    key = F.md5(F.concat_ws("_", F.col("user_id").cast("string"), F.lit(str(seed))))
    users = df.select("user_id").distinct()
    cut = first_of_groups(users, F.lit(0), key, ["user_id"],
                          lambda n: {g: sample_size(c, frac, floor) for g, c in n.items()})
    return df.where(cut.keep) if cut.totals else df           # the cut is on the user alone: no join


def balanced_sample(df: DataFrame, per_class: int, seed: int = 42) -> DataFrame:
    """``min(per_class, #class)`` rows of each label (0 and 1), both classes
    cut by one selection."""
    group = F.when(F.col("label").isin(0, 1), F.col("label"))
    return first_of_groups(df, group, _key(seed), _then(df), lambda n: {g: int(per_class) for g in n}).of(df)


def group_kfold(df: DataFrame, n_splits: int = 5, seed: int = 42, col: str = "fold") -> DataFrame:
    """Fold by user (a user never spans two folds)."""
    return df.withColumn(col, hash_bucket(seed, n_splits, "user_id"))


def deal_sizes(histogram: Sequence[tuple[int, int]], k: int) -> list[tuple[int, int, int, list[int]]]:
    """How a greedy splitter deals groups to k folds, largest group first, each to
    the fold with the fewest rows (ties: the lower fold), from the number of
    groups of each size alone.

    Groups of one size are dealt in rounds: the folds less than one group above
    the emptiest take one each, in the order of their rows, until a further fold
    joins them. Returns (size, first, last, folds): the groups of a size with
    ranks first..last take ``folds`` in turn."""
    load, out = [0] * k, []
    for size, groups in sorted(histogram, reverse=True):
        rank = 0
        while rank < groups:
            low = min(load)
            turn = sorted((f for f in range(k) if load[f] < low + size), key=lambda f: (load[f], f))
            rest = [load[f] for f in range(k) if load[f] >= low + size]
            rounds = min((x - low) // size for x in rest) if rest else groups
            took = min(groups - rank, rounds * len(turn))
            out.append((size, rank, rank + took - 1, turn))
            for at, f in enumerate(turn):
                load[f] += size * (took // len(turn) + (at < took % len(turn)))
            rank += took
    return out


#: Rows of the dealing table up to which it is broadcast.
FEW_SIZES = 100_000


def group_kfold_balanced(df: DataFrame, n_splits: int = 5, seed: int = 42, col: str = "fold") -> DataFrame:
    """N8 with folds as even as a greedy splitter's: users by falling number of
    rows (then hash order), each to the smallest fold.

    Only the histogram of sizes reaches the driver (with n rows at most
    sqrt(2n) sizes); users find their fold by size and rank, and the rows theirs
    by user, a join that AQE splits for a user with many rows."""
    key = F.md5(F.concat_ws("_", F.col("user_id").cast("string"), F.lit(str(seed))))
    users = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_size"))
    ranked = materialize(row_number_within(users.withColumn("_k", key), ["_size"], ["_k", "user_id"], "_rank"), "users-by-size")
    sizes = [(r["_size"], r["n"]) for r in ranked.groupBy("_size").agg(F.count(F.lit(1)).alias("n")).collect()]
    dealt = deal_sizes(sizes, int(n_splits))
    table = df.sparkSession.createDataFrame(dealt, "_size long, _first long, _last long, _turn array<int>")
    if len(dealt) <= FEW_SIZES:
        table = F.broadcast(table)
    at = F.col("_rank") - 1
    folds = (ranked.join(table, "_size").where(at.between(F.col("_first"), F.col("_last")))
             .select("user_id", F.element_at("_turn", (F.pmod(at - F.col("_first"), F.size("_turn")) + 1).cast("int")).alias(col)))
    return df.join(folds, "user_id").select(*df.columns, col)


def stratified_kfold(df: DataFrame, n_splits: int = 5, seed: int = 42, col: str = "fold") -> DataFrame:
    """Rows of each label dealt round-robin in hash order: every fold gets
    floor or ceil of 1/k of each class."""
    ranked = rank_cells(df, F.col("label"), _key(seed), _then(df), "_rn")
    return ranked.withColumn(col, F.pmod(F.col("_rn") - 1, F.lit(int(n_splits))).cast("int")).drop("_rn")


def recency_bucket(df: DataFrame, bounds: Sequence[int] = (1, 3, 7), col: str = "bucket") -> DataFrame:
    """N4 as a column."""
    return df.withColumn(col, bucket_index(GAP, bounds))


def shuffle_rows(df: DataFrame) -> DataFrame:
    """DataFrames are unordered; a row shuffle is a no-op."""
    return df

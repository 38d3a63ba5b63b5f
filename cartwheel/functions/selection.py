"""Exact cuts in hash order by radix selection: several groups in one pass.

"The first n rows of each group in the order of a hash" is answered without
sorting the rows. One aggregate counts every (group, leading 16 bits of the
hash); adding the counts up gives, for every group at once, the prefix in which
its n-th row lies. A second pass reads that prefix alone (1/65,536 of a group)
and ranks its narrow keys, which gives the group's last key. The cut itself is
then a filter on the wide rows: they are neither shuffled, sorted nor written.

What reaches the driver is bounded by the number of groups (classes, recency
buckets), not by the rows: 65,536 counts and one key for each. ``rank_cells``
serves uses that need every row's rank: a cell's rank base comes from the same
counts, and rows are ranked within their cell, spread over tasks by the hash.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.ranking import row_number_within, take_first

#: Hex digits of a prefix, and prefixes.
DIGITS = 4
CELLS = 16 ** DIGITS
#: Groups whose counts are read at a time, a bound on the driver's table.
MAX_GROUPS = 1000
#: Rows of a cell that one task ranks; larger cells are ranked by all tasks.
CELL_ROWS = 1_000_000


def prefix(key: Column) -> Column:
    """The leading digits of a hex text as a number."""
    return F.conv(F.substring(key, 1, DIGITS), 16, 10).cast("int")


def counts_by_prefix(rows: DataFrame, group: Column, key: Column) -> dict[int, np.ndarray]:
    """For each group (an integer; null groups are left out) the rows of every prefix."""
    counts = (rows.select(group.cast("int").alias("g"), prefix(key).alias("p")).where("g IS NOT NULL")
              .groupBy("g", "p").agg(F.count(F.lit(1)).alias("c")))
    table = counts.toArrow()                       # groups x 65,536 rows at most
    g, p, c = (table[n].to_numpy() for n in ("g", "p", "c"))
    found = np.unique(g)
    if len(found) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups in one selection")
    out = {}
    for one in found:
        here = g == one
        out[int(one)] = np.bincount(p[here], weights=c[here], minlength=CELLS).astype(np.int64)
    return out


@dataclass
class Cut:
    """The first rows of each group: ``keep`` holds for rows inside; ``ties``
    lists (condition, n) of equal rows of which n are inside."""

    totals: dict[int, int]
    keep: Column
    ties: list[tuple[Column, int]]

    def of(self, rows: DataFrame) -> DataFrame:
        out = rows.where(self.keep)
        for cond, n in self.ties:                  # rows equal in every ordering column
            equal = rows.where(cond)
            out = out.unionByName(take_first(equal, n, [F.xxhash64(*equal.columns), *equal.columns]))
        return out


def first_of_groups(rows: DataFrame, group: Column, key: Column, then: Sequence[str],
                    quotas: Callable[[dict[int, int]], dict[int, int]]) -> Cut:
    """A cut of ``quotas(totals)`` rows of each group in the order of ``key`` (a
    hex hash), then of the columns ``then``; ``totals`` are the groups' rows."""
    counts = counts_by_prefix(rows, group, key)
    totals = {g: int(c.sum()) for g, c in counts.items()}
    whole, edge = [], {}
    for g, n in quotas(totals).items():
        if n >= totals.get(g, 0):
            whole.append(g)
        elif n > 0:
            upto = np.cumsum(counts[g])
            p = int(np.searchsorted(upto, n))
            edge[g] = (p, n - int(upto[p] - counts[g][p]), int(counts[g][p]))
    group = group.cast("int")
    order = F.struct(key.alias("k"), *then)
    keep = group.isin(whole) if whole else F.lit(False)
    if not edge:
        return Cut(totals, keep, [])

    # Each group's cell at the edge, narrow: where its n-th row lies.
    at, rank = F.lit(None).cast("int"), F.lit(None).cast("long")
    for g, (p, r, _) in edge.items():
        at, rank = F.when(group == g, F.lit(p)).otherwise(at), F.when(F.col("g") == g, F.lit(r)).otherwise(rank)
    cells = rows.where(prefix(key) == at).select(group.alias("g"), order.alias("o"))
    if max(c for _, _, c in edge.values()) <= CELL_ROWS:
        ranked = cells.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    else:
        ranked = row_number_within(cells, ["g"], ["o"], "r")
    equal = ranked.groupBy("g", "o").agg(F.min("r").alias("lo"), F.max("r").alias("hi"))
    last = equal.where((F.col("lo") <= rank) & (rank <= F.col("hi"))).collect()          # one row a group
    ties = []
    for row in last:
        g, n = row["g"], edge[row["g"]][1]
        bound = F.struct(*(F.lit(row["o"][f.name]).cast(f.dataType).alias(f.name) for f in cells.schema["o"].dataType))
        if n == row["hi"]:
            keep = keep | ((group == g) & (order <= bound))
        else:
            keep = keep | ((group == g) & (order < bound))
            ties.append(((group == g) & (order == bound), n - row["lo"] + 1))
    return Cut(totals, keep, ties)


def rank_cells(rows: DataFrame, group: Column, key: Column, then: Sequence[str], out_col: str) -> DataFrame:
    """Adds each row's rank (from 1) in its group, in the order of ``key`` and
    ``then``: rows are shuffled once, by (group, prefix). Null groups get null."""
    counts = counts_by_prefix(rows, group, key)
    if any(int(c.max()) > CELL_ROWS for c in counts.values()):
        marked = rows.withColumns({"_g": group.cast("int"), "_k": key})
        ranked = row_number_within(marked.where("_g IS NOT NULL"), ["_g"], ["_k", *then], out_col)
        rest = marked.where("_g IS NULL").withColumn(out_col, F.lit(None).cast("long"))
        return ranked.unionByName(rest).drop("_g", "_k")
    spark = rows.sparkSession
    base = [(g, int(p), int(n)) for g, c in counts.items() for p, n in zip(np.flatnonzero(c), (np.cumsum(c) - c)[c > 0], strict=True)]
    bases = spark.createDataFrame(base, "_g int, _p int, _base long")             # groups x 65,536 rows at most
    cell = Window.partitionBy("_g", "_p").orderBy(F.col("_k"), *then)
    marked = rows.withColumns({"_g": group.cast("int"), "_k": key, "_p": prefix(key)})
    ranked = marked.withColumn("_r", F.row_number().over(cell)).join(F.broadcast(bases), ["_g", "_p"], "left")
    return ranked.withColumn(out_col, F.col("_base") + F.col("_r")).drop("_g", "_p", "_k", "_r", "_base")

"""Distributed ranking helpers.

* ``top_k_per_group`` -- exact per-group top-k. ``row_number() <= k`` with a
  literal k lets Spark plan a *partial* WindowGroupLimit before the shuffle,
  so even a group that holds a third of all rows sends at most k rows per map
  partition to its reducer. For k above Spark's group-limit threshold the
  helper salts the group first (exact: every global top-k row is in the top-k
  of its salt slice).
* ``global_row_number`` -- exact 1-based position in a total order without a
  single-partition window: range-partition on the order, number rows inside
  each range partition, add the row counts of the earlier partitions.
* ``global_cum_sum`` -- sum of a weight over all rows strictly before each row
  in a total order, same scheme.

Every order passed in must be total (append unique tie-break columns), or the
results are not repeatable.

Range partitioning samples its boundaries with a seed tied to the RDD id, so
two separately planned uses of one ``repartitionByRange`` may cut differently.
The two global helpers therefore materialise the range-partitioned rows once
with a reliable ``checkpoint()`` (the cluster's ``spark.checkpoint.dir``);
the partition counts and the numbered rows are read from that one copy. The
checkpoint is also the lineage cut that lets the cut survive executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import ensure_checkpoint_dir

# Spark plans a partial WindowGroupLimit only up to this k
# (spark.sql.optimizer.windowGroupLimitThreshold, default 1000).
GROUP_LIMIT_THRESHOLD = 1000
_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row index


def _cols(cs) -> list:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence,
                    k: int, rank_col: str = "rn", salt_buckets: int = 32,
                    salt_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows ranked ``1..k`` inside each group by ``order_cols`` (ties must be broken)."""
    k = int(k)
    order = _cols(order_cols)
    if k <= GROUP_LIMIT_THRESHOLD:
        w = Window.partitionBy(*group_cols).orderBy(*order)
        return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= F.lit(k))
    # Large k: salt the group so a hot group is ranked by many tasks first.
    salt_src = list(salt_cols) if salt_cols else [c for c in df.columns if c not in group_cols][:2]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_src), F.lit(int(salt_buckets))))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order)
    first = salted.withColumn("_rn1", F.row_number().over(w1)).where(F.col("_rn1") <= F.lit(k))
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return (
        first.drop("_rn1", "_salt")
        .withColumn(rank_col, F.row_number().over(w2))
        .where(F.col(rank_col) <= F.lit(k))
    )


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(1, int(conf))


def global_row_number(df: DataFrame, order_cols: Sequence, out_col: str = "grn",
                      num_partitions: int | None = None) -> DataFrame:
    """Exact 1-based row number in a total order, computed by all tasks.

    The per-range-partition counts table has one row per partition, so the
    broadcast of the offsets is bounded by ``num_partitions``.
    """
    n = _num_partitions(df, num_partitions)
    order = _cols(order_cols)
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
        .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
    )
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # <= n rows: a single-partition window over the partition table is fine.
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(out_col, (F.col("_off") + local + 1).cast("bigint"))
        .drop("_mid", "_pid", "_off")
    )


FEW_GROUPS = 10_000


def row_number_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence,
                      out_col: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Exact row number inside groups of any size (few huge groups are fine).

    Global row number over ``(group, order)`` minus the group's first position.
    A few groups' positions (``FEW_GROUPS`` at most, counted) are broadcast, so
    rows of a class that holds most of them aren't shuffled by it; many groups
    meet their rows in a shuffle join.
    """
    ranked = global_row_number(df, list(group_cols) + list(order_cols), "_grn", num_partitions)
    starts = ranked.groupBy(*group_cols).agg(F.min("_grn").alias("_start"))
    if starts.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        starts = F.broadcast(starts)
    return (
        ranked.join(starts, list(group_cols))
        .withColumn(out_col, (F.col("_grn") - F.col("_start") + 1).cast("bigint"))
        .drop("_grn", "_start")
    )


def global_cum_sum(df: DataFrame, order_cols: Sequence, weight: str,
                   out_col: str = "cum_before", num_partitions: int | None = None) -> DataFrame:
    """Sum of ``weight`` over all rows strictly before each row in a total order."""
    n = _num_partitions(df, num_partitions)
    order = _cols(order_cols)
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(n, *order)
        .withColumn("_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    totals = ranged.groupBy("_pid").agg(F.sum(weight).alias("_tot"))
    offsets = totals.select(
        "_pid",
        F.coalesce(
            F.sum("_tot").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_within", F.coalesce(F.sum(weight).over(w), F.lit(0)))
        .join(F.broadcast(offsets), "_pid")
        .withColumn(out_col, F.col("_off") + F.col("_within"))
        .drop("_pid", "_off", "_within")
    )


# Tail levels tried by the top-n pre-filter: 2^-i of the rows.
_TAIL_SHARES = [2.0 ** -i for i in range(1, 31)]


def _lead_floor(df: DataFrame, n: int, lead: Column, descending: bool):
    """A bound ``t`` on the leading order key such that at least n rows lie on
    the good side (``lead >= t`` descending, ``lead <= t`` ascending), checked
    exactly; picked from approximate quantiles so that side holds a few times
    n rows. None when no useful bound exists (then every row is ranked)."""
    levels = [1.0 - s for s in _TAIL_SHARES] if descending else list(_TAIL_SHARES)
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(lead.cast("double"), levels, 10000).alias("_q"),
    ).first()
    total, qs = int(row["_n"]), row["_q"]
    if total <= n or not qs:
        return None
    want = min(1.0, 4.0 * n / total)
    t = None
    for share, q in zip(_TAIL_SHARES, qs):
        if share >= want and q is not None:
            t = q
    if t is None:
        return None
    keep = lead >= F.lit(t) if descending else lead <= F.lit(t)
    if df.where(keep).limit(n).count() < n:   # exact check
        return None
    return keep


def take_first(df: DataFrame, n: int | None, order_cols: Sequence,
               num_partitions: int | None = None, score_col: str | None = None,
               lead: tuple | None = None) -> DataFrame:
    """First ``n`` rows in a total order (``n`` None or <= 0: all rows).

    A distributed exact cut instead of ``orderBy().limit()``, whose final merge
    runs in one task that receives up to n rows from every partition.

    Pre-filter for n much smaller than the row count: ``score_col`` names a
    leading descending numeric column, or ``lead = (column, descending)`` gives
    a numeric key that orders rows like the leading order column (for example
    the first hex digits of an md5 order key). Only rows on the good side of a
    bound holding at least n rows (verified) are ranked, so the cut is exact.
    """
    if n is None or int(n) <= 0:
        return df
    n = int(n)
    cols = df.columns
    src = df
    if score_col is not None and lead is None:
        lead = (F.col(score_col), True)
    if lead is not None:
        keep = _lead_floor(df, n, lead[0], bool(lead[1]))
        if keep is not None:
            src = df.where(keep)
    return global_row_number(src, order_cols, "_grn", num_partitions) \
        .where(F.col("_grn") <= F.lit(n)).select(*cols)


"""Candidate generation (recall): C1-C8, U1-U3, F1, F4, F6, F7.

Plan: read only days ``[L-14, L]`` (partition pruning), semi-join the item
subset P, and compute *all* route flags in one ``groupBy(user_id, item_id)``
(partial aggregation before the shuffle). Every candidate set is a filter on
that one flags table; the per-user cap is a ``row_number`` over the best tier.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import lit_date
from cartwheel.functions.ranking import top_k_per_group
from cartwheel.schemas import PURCHASE, RECENT_DAYS, STRONG_BEHAVIOURS, STRONG_DAYS
from cartwheel.session import materialize
from cartwheel.sources.daily_logs import actions_between
from cartwheel.sources.items import item_set

FLAG_COLUMNS = ["t_recent", "t_strong", "t_label", "p_recent", "p_strong"]


def _d(x) -> _dt.date:
    if isinstance(x, _dt.date):
        return x
    s = str(x).replace("-", "")
    return _dt.date(int(s[:4]), int(s[4:6]), int(s[6:8]))


def windows(label_date) -> dict:
    """Inclusive recall windows; predict windows are the train ones shifted by a day."""
    L = _d(label_date)
    P = L + _dt.timedelta(days=1)
    day = _dt.timedelta
    return {
        "t_recent": (L - day(RECENT_DAYS), L - day(1)),
        "t_strong": (L - day(STRONG_DAYS), L - day(1)),
        "p_recent": (P - day(RECENT_DAYS), P - day(1)),
        "p_strong": (P - day(STRONG_DAYS), P - day(1)),
        "label": (L, L),
    }


def in_target(actions: DataFrame, items: DataFrame) -> DataFrame:
    """actions whose item is in P (semi-join; AQE broadcasts a small P)."""
    return actions.join(item_set(items), "item_id", "left_semi")


def buys_on_day(actions: DataFrame, day) -> DataFrame:
    """F7 + S4: distinct pairs bought on ``day``."""
    return (
        actions.where((F.col("dt") == lit_date(_d(day))) & (F.col("behavior_type") == PURCHASE))
        .select("user_id", "item_id").distinct()
    )


def pair_flags(actions: DataFrame, items: DataFrame, label_date) -> DataFrame:
    """C1 + C2 in one pass: one row per pair seen in ``[L-14, L]`` within P,
    with a boolean per route (train recent/strong/label, predict recent/strong)."""
    w = windows(label_date)
    lo = w["t_strong"][0]
    hi = w["label"][1]
    a = in_target(actions_between(actions, lo, hi), items)
    dt = F.col("dt")
    strong = F.col("behavior_type").isin(*STRONG_BEHAVIOURS)

    def flag(cond):
        return F.max(F.when(cond, F.lit(True)).otherwise(F.lit(False)))

    def between(name):
        s, e = w[name]
        return dt.between(lit_date(s), lit_date(e))

    return a.groupBy("user_id", "item_id").agg(
        flag(between("t_recent")).alias("t_recent"),
        flag(between("t_strong") & strong).alias("t_strong"),
        flag((dt == lit_date(w["label"][0])) & (F.col("behavior_type") == PURCHASE)).alias("t_label"),
        flag(between("p_recent")).alias("p_recent"),
        flag(between("p_strong") & strong).alias("p_strong"),
    )


#: Days a pair's masks look back: bit 0 is the label day, bit 14 the oldest day of recall.
MASK_DAYS = STRONG_DAYS + 1
MASKS = ("any_days", "strong_days", "buy_days")


def pair_masks(actions: DataFrame, items: DataFrame, label_date) -> DataFrame:
    """The days on which each pair was seen, as bit masks (bit k: k days before
    the label day): any behaviour, collect / cart, purchase. From these every
    recall flag of the day follows, and those of the next day (``roll_masks``)."""
    L = _d(label_date)
    a = in_target(actions_between(actions, L - _dt.timedelta(days=STRONG_DAYS), L), items)
    return _masks_of(a, L)


def _masks_of(rows: DataFrame, label_date: _dt.date) -> DataFrame:
    bit = F.call_function("shiftleft", F.lit(1), F.datediff(lit_date(label_date), F.col("dt")))
    strong = F.col("behavior_type").isin(*STRONG_BEHAVIOURS)

    def days(cond):
        return F.bit_or(F.when(cond, bit).otherwise(F.lit(0)))

    return rows.groupBy("user_id", "item_id").agg(
        days(F.lit(True)).alias("any_days"), days(strong).alias("strong_days"),
        days(F.col("behavior_type") == PURCHASE).alias("buy_days"))


def roll_masks(masks: DataFrame, actions: DataFrame, items: DataFrame, new_label_date) -> DataFrame:
    """The masks of ``new_label_date`` from those of the day before: every mask
    moves up a day, the oldest day falls out, and the new day's actions (the only
    ones read) set bit 0. Pairs without a day left are dropped. The item subset
    has to be the one the masks were built with."""
    day = _d(new_label_date)
    full = (1 << MASK_DAYS) - 1
    old = masks.select("user_id", "item_id", *(F.shiftleft(m, 1).bitwiseAND(F.lit(full)).alias(m) for m in MASKS))
    new = _masks_of(in_target(actions_between(actions, day, day), items), day)
    both = old.where(F.col("any_days") != 0).unionByName(new)
    return both.groupBy("user_id", "item_id").agg(*(F.bit_or(m).alias(m) for m in MASKS))


def flags_of_masks(masks: DataFrame) -> DataFrame:
    """C1 + C2 from the masks: the table of ``pair_flags``."""
    def days(mask, first, last):
        return F.col(mask).bitwiseAND(F.lit(sum(1 << k for k in range(first, last + 1)))) != 0

    return masks.select(
        "user_id", "item_id",
        days("any_days", 1, RECENT_DAYS).alias("t_recent"),
        days("strong_days", 1, STRONG_DAYS).alias("t_strong"),
        days("buy_days", 0, 0).alias("t_label"),
        days("any_days", 0, RECENT_DAYS - 1).alias("p_recent"),
        days("strong_days", 0, STRONG_DAYS - 1).alias("p_strong"))


def _pairs(flags: DataFrame, cond) -> DataFrame:
    return flags.where(cond).select("user_id", "item_id")


def recall_recent(flags: DataFrame, mode: str = "train") -> DataFrame:
    """Distinct pairs with any behaviour in the 7-day window."""
    return _pairs(flags, F.col("t_recent" if mode == "train" else "p_recent"))


def recall_strong(flags: DataFrame, mode: str = "train") -> DataFrame:
    """Distinct pairs with collect/cart in the 14-day window."""
    return _pairs(flags, F.col("t_strong" if mode == "train" else "p_strong"))


def recall_union(flags: DataFrame, mode: str = "train") -> DataFrame:
    """Recent union strong (one filter on the flags table, no union shuffle)."""
    if mode == "train":
        return _pairs(flags, F.col("t_recent") | F.col("t_strong"))
    return _pairs(flags, F.col("p_recent") | F.col("p_strong"))


def label_pairs(flags: DataFrame) -> DataFrame:
    """Pairs bought on the label day (within P)."""
    return _pairs(flags, F.col("t_label"))


def kept_label(align_recall: bool = True, pos_filter_in_recall: bool = True):
    """The label flag after the optional alignment with recall."""
    if align_recall and pos_filter_in_recall:
        return F.col("t_label") & (F.col("t_recent") | F.col("t_strong"))
    return F.col("t_label")


def label_pairs_aligned(flags: DataFrame) -> DataFrame:
    """Label pairs that recall also found (intersection)."""
    return _pairs(flags, kept_label(True, True))


def label_pairs_dropped(flags: DataFrame) -> DataFrame:
    """U3 log line: how many label pairs the alignment drops (one row)."""
    return flags.agg(
        F.count(F.when(F.col("t_label"), 1)).alias("label_pairs"),
        F.count(F.when(kept_label(True, True), 1)).alias("kept"),
        F.count(F.when(F.col("t_label") & ~(F.col("t_recent") | F.col("t_strong")), 1)).alias("dropped"),
    )


def _capped(flags: DataFrame, tier, max_per_user: int | None) -> DataFrame:
    """C4: best tier per pair, at most ``max_per_user`` items per user,
    filled in tier order (ties broken by item_id)."""
    t = flags.withColumn("tier", tier).where(F.col("tier").isNotNull())
    if max_per_user is None:
        return t
    return top_k_per_group(t, ["user_id"], [F.col("tier"), F.col("item_id")], int(max_per_user)).drop("rn")


def train_candidates(flags: DataFrame, max_per_user: int | None = None,
                     align_recall: bool = True, pos_filter_in_recall: bool = True) -> DataFrame:
    """``user_id, item_id, label``; tiers label(0) > strong(1) > recent(2)."""
    lab = kept_label(align_recall, pos_filter_in_recall)
    tier = (
        F.when(lab, F.lit(0))
        .when(F.col("t_strong"), F.lit(1))
        .when(F.col("t_recent"), F.lit(2))
    )
    out = _capped(flags.withColumn("_lab", lab), tier, max_per_user)
    return out.select("user_id", "item_id", F.col("_lab").cast("int").alias("label"))


def pred_candidates(flags: DataFrame, max_per_user: int | None = None) -> DataFrame:
    """C4 for predict: tiers strong(1) > recent(2)."""
    tier = F.when(F.col("p_strong"), F.lit(1)).when(F.col("p_recent"), F.lit(2))
    return _capped(flags, tier, max_per_user).select("user_id", "item_id")


def hot_items(actions: DataFrame, items: DataFrame, label_date, top: int) -> DataFrame:
    """The ``top`` items by action count in the predict recent window (in P).

    ``item_id, cnt, hot_rank``. The result has at most ``top`` rows; the cut is
    the feature (a top-k report), so a plain ordered limit is used.
    """
    s, e = windows(label_date)["p_recent"]
    counts = in_target(actions_between(actions, s, e), items).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("cnt"))
    top_rows = counts.orderBy(F.col("cnt").desc(), F.col("item_id")).limit(int(top))
    return top_rows.withColumn(
        "hot_rank",
        # at most `top` rows: a single-partition window is bounded
        F.row_number().over(Window.orderBy(F.col("cnt").desc(), F.col("item_id"))),
    )


def backfill_hot(pred: DataFrame, hot: DataFrame, max_per_user: int) -> DataFrame:
    """Users under the cap get unseen hot items appended in hot-rank order.

    A user with n candidates has room for ``max_per_user - n`` more and owns at
    most n hot items, so the first ``max_per_user`` of the list are all that can
    be needed: they are collected as a literal array, however long the list. The
    candidates are written once; one aggregate over them gives each user's size
    and owned *hot* items, never the whole candidate list. No cross join.
    """
    hot_ids = [r["item_id"] for r in hot.orderBy("hot_rank").select("item_id").limit(int(max_per_user)).collect()]
    pred = materialize(pred.select("user_id", "item_id"), "pred-candidates")
    if not hot_ids:
        return pred
    hot_arr = F.array(*[F.lit(int(i)).cast("bigint") for i in hot_ids])
    owned = F.collect_set(F.when(F.col("item_id").isin(hot_ids), F.col("item_id"))).alias("owned")
    room = (
        pred.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), owned)
        .where(F.col("n") < F.lit(int(max_per_user)))
        .select(
            "user_id",
            F.slice(
                F.filter(hot_arr, lambda x: ~F.array_contains(F.col("owned"), x)),
                F.lit(1),
                (F.lit(int(max_per_user)) - F.col("n")).cast("int"),
            ).alias("fill"),
        )
    )
    extra = room.select("user_id", F.explode("fill").alias("item_id"))
    return pred.unionByName(extra)


def candidate_stats(train: DataFrame) -> DataFrame:
    """Rows, positives, negatives and neg/pos (infinity when no positive)."""
    agg = train.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("label"), F.lit(0)).cast("bigint").alias("pos"),
    )
    return agg.select(
        "rows", "pos",
        (F.col("rows") - F.col("pos")).alias("neg"),
        F.when(F.col("pos") > 0, (F.col("rows") - F.col("pos")).cast("double") / F.col("pos"))
        .otherwise(F.lit(float("inf"))).alias("neg_pos_ratio"),
    )

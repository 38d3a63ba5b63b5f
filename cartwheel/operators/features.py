"""Point-in-time features for candidate pairs: A1-A21, J1-J7, F2, F3, F5.

Population for every block: actions with ``dt < ref`` (partition pruning),
item in P, user among the candidate users. Those rows are first reduced to a
``(user, item, category, day)`` grain with per-behaviour counts; the user,
item, pair and user-category blocks are ``groupBy`` aggregates of that one
table, so Spark computes it once and reuses the exchange.

Defaults for keys without activity: counts 0, day gaps 999, span 0, ratios 0.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.exprs import days_since, lit_date, safe_div
from cartwheel.functions.prefilter import maybe_in
from cartwheel.schemas import (
    FEATURE_COLUMNS, ITEM_FEATURES, NEVER_DAYS, PAIR_FEATURES, USER_CATEGORY_FEATURES,
    USER_FEATURES, USER_RECENT_LONG, USER_RECENT_SHORT,
)
from cartwheel.session import materialize_bucketed
from cartwheel.sources.daily_logs import actions_before
from cartwheel.sources.items import item_set


PAIR = ("user_id", "item_id")


def _d(x) -> _dt.date:
    if isinstance(x, _dt.date):
        return x
    s = str(x).replace("-", "")
    return _dt.date(int(s[:4]), int(s[4:6]), int(s[6:8]))


def reference_day(label_date, is_training: bool) -> _dt.date:
    """Train features are cut at L, predict features at L + 1."""
    L = _d(label_date)
    return L if is_training else L + _dt.timedelta(days=1)


def feature_population(actions: DataFrame, items: DataFrame, candidates: DataFrame, ref) -> DataFrame:
    """F5 + F1 + F2 as a daily grain: ``dt < ref``, item in P, user among
    candidate users. Rows of other items and users mostly go in the tasks that
    read them (``functions.prefilter``); the log is then reduced to the grain, so
    it is combined in the map tasks and spread by all four keys; only the compact
    grain meets the exact item and user sets."""
    log = maybe_in(maybe_in(actions_before(actions, _d(ref)), items, "item_id"), candidates, "user_id")
    return grain_population(daily_grain(log), items, candidates, ref)


def daily_grain(population: DataFrame) -> DataFrame:
    """Per ``(user, item, category, day)``: row count and per-behaviour counts."""
    bt = F.col("behavior_type")

    def cnt(code):
        return F.sum(F.when(bt == code, F.lit(1)).otherwise(F.lit(0))).cast("bigint")

    return population.groupBy("user_id", "item_id", "item_category", "dt").agg(
        F.count(F.lit(1)).alias("n"),
        cnt(1).alias("n1"), cnt(2).alias("n2"), cnt(3).alias("n3"), cnt(4).alias("n4"),
    )


def _recent(ref, days: int):
    return F.col("dt") >= lit_date(_d(ref) - _dt.timedelta(days=days))


def _z(c: str):
    """Count column with 0 for a missing key."""
    return F.coalesce(F.col(c), F.lit(0)).cast("bigint")


#: Days of a mask (a long without its sign), and masks of a user at most.
MASK_DAYS, MAX_MASKS = 63, 64


def day_masks(ref, words: int) -> list:
    """The days before ``ref`` on which a key was seen, as ``words`` bit masks:
    bit k of mask j is the day ``ref - 1 - (MASK_DAYS j + k)``. Masks of parts of
    the rows combine by ``bit_or``, so days are counted without a shuffle by day."""
    back = F.datediff(lit_date(_d(ref)), F.col("dt")) - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(back, F.lit(MASK_DAYS)))
    word = F.floor(back / F.lit(MASK_DAYS))
    return [F.bit_or(F.when(word == j, bit).otherwise(F.lit(0).cast("long"))).alias(f"_days_{j}") for j in range(words)]


def mask_days(words: int):
    """How many days the masks hold."""
    return sum((F.bit_count(f"_days_{j}") for j in range(words)), F.lit(0)).cast("bigint")


def _mask_words(daily: DataFrame, ref) -> int:
    """Masks that the log's history needs (its first day is one small aggregate)."""
    first = daily.agg(F.min("dt")).first()[0]
    return max(1, -(-(_d(ref) - first).days // MASK_DAYS)) if first is not None else 1


def user_aggregates(daily: DataFrame, ref) -> DataFrame:
    """A1-A6 raw aggregates per user (only users with activity): one aggregate
    whose day masks combine in the map tasks. A history too long for the masks
    (eleven years) counts days from rows reduced to (user, day)."""
    words = _mask_words(daily, ref)
    if words > MAX_MASKS:
        days = daily.groupBy("user_id", "dt").agg(*[F.sum(c).alias(c) for c in ("n", "n1", "n2", "n3", "n4")])
        per_user = _user_sums(days, ref, [F.count("dt").alias("active_days")])
    else:
        masks = _user_sums(daily, ref, day_masks(ref, words))
        per_user = masks.withColumn("active_days", mask_days(words)).drop(*(f"_days_{j}" for j in range(words)))
    categories = (daily.select("user_id", "item_category").distinct()
                  .groupBy("user_id").agg(F.count("item_category").alias("unique_categories")))
    return per_user.join(categories, "user_id")


def _user_sums(rows: DataFrame, ref, more: list) -> DataFrame:
    return rows.groupBy("user_id").agg(
        F.sum("n").alias("user_total_actions"),
        F.sum("n1").alias("behavior_1_count"),
        F.sum("n2").alias("behavior_2_count"),
        F.sum("n3").alias("behavior_3_count"),
        F.sum("n4").alias("behavior_4_count"),
        *more,
        F.sum(F.when(_recent(ref, USER_RECENT_LONG), F.col("n")).otherwise(0)).cast("bigint").alias("recent_7d_actions"),
        F.sum(F.when(_recent(ref, USER_RECENT_SHORT), F.col("n")).otherwise(0)).cast("bigint").alias("recent_3d_actions"),
        F.max("dt").alias("_u_last"),
    )


def user_columns(ref) -> list:
    """A1-A8 with defaults, over a row that may lack the user aggregate."""
    return [
        _z("user_total_actions").alias("user_total_actions"),
        _z("behavior_1_count").alias("behavior_1_count"),
        _z("behavior_2_count").alias("behavior_2_count"),
        _z("behavior_3_count").alias("behavior_3_count"),
        _z("behavior_4_count").alias("behavior_4_count"),
        safe_div(_z("behavior_4_count"), _z("user_total_actions")).alias("purchase_rate"),
        _z("active_days").alias("active_days"),
        safe_div(_z("user_total_actions"), _z("active_days")).alias("avg_actions_per_day"),
        _z("recent_7d_actions").alias("recent_7d_actions"),
        _z("recent_3d_actions").alias("recent_3d_actions"),
        days_since(ref, "_u_last").alias("days_since_last_action"),
        _z("unique_categories").alias("unique_categories"),
    ]


def item_aggregates(daily: DataFrame, candidates: DataFrame, ref) -> DataFrame:
    """A9-A12 raw aggregates for candidate items (F3); activity of candidate users only."""
    cand_items = candidates.select("item_id").distinct()

    def recent_views(days):
        return F.sum(F.when(_recent(ref, days), F.col("n1")).otherwise(0)).cast("bigint")

    # One row per user of an item, then one per item: a hot item is spread by its users first.
    per_user = daily.groupBy("item_id", "user_id").agg(
        F.sum("n").alias("n"), F.sum("n4").alias("n4"), F.sum("n1").alias("n1"),
        recent_views(USER_RECENT_LONG).alias("v7"), recent_views(USER_RECENT_SHORT).alias("v3"), F.max("dt").alias("last"))
    per_item = per_user.groupBy("item_id").agg(
        F.sum("n").alias("item_total_actions"),
        F.sum("n4").alias("total_purchases"),
        F.count("user_id").alias("unique_users"),
        F.sum("n1").alias("views"),
        F.sum("v7").alias("recent_7d_views"),
        F.sum("v3").alias("recent_3d_views"),
        # Last day of *any* action by candidate users (quirk Q2).
        F.max("last").alias("_i_last"),
    )
    return per_item.join(cand_items, "item_id", "left_semi")


def item_columns(ref) -> list:
    """A9-A14 with defaults (without the category)."""
    return [
        _z("item_total_actions").alias("item_total_actions"),
        _z("total_purchases").alias("total_purchases"),
        _z("unique_users").alias("unique_users"),
        _z("views").alias("views"),
        safe_div(_z("total_purchases"), _z("views")).alias("conversion_rate"),
        safe_div(_z("item_total_actions"), _z("unique_users")).alias("avg_actions_per_user"),
        _z("recent_7d_views").alias("recent_7d_views"),
        _z("recent_3d_views").alias("recent_3d_views"),
        days_since(ref, "_i_last").alias("days_since_last_view"),
    ]


def pair_aggregates(daily: DataFrame) -> DataFrame:
    """A15-A16 raw aggregates per pair."""
    return daily.groupBy("user_id", "item_id").agg(
        F.sum("n").alias("ui_total_actions"),
        F.sum("n1").alias("ui_view_count"),
        F.sum("n2").alias("ui_collect_count"),
        F.sum("n3").alias("ui_cart_count"),
        F.sum("n4").alias("ui_purchase_count"),
        F.min("dt").alias("_p_first"),
        F.max("dt").alias("_p_last"),
    )


def pair_columns(ref) -> list:
    """A15-A17 with defaults: gap 999 and span 0 for an unseen pair."""
    span = F.when(F.col("_p_first").isNotNull() & F.col("_p_last").isNotNull(),
                  F.datediff(F.col("_p_last"), F.col("_p_first")) + 1).otherwise(F.lit(0)).cast("int")
    return [
        _z("ui_total_actions").alias("ui_total_actions"),
        _z("ui_view_count").alias("ui_view_count"),
        _z("ui_collect_count").alias("ui_collect_count"),
        _z("ui_cart_count").alias("ui_cart_count"),
        _z("ui_purchase_count").alias("ui_purchase_count"),
        days_since(ref, "_p_last").alias("ui_days_since_last_action"),
        span.alias("ui_action_span_days"),
        safe_div(_z("ui_total_actions"), span).alias("ui_avg_actions_per_day"),
    ]


def needed_user_categories(candidates: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (user, P-category) of the candidates (null when item not in P)."""
    return (
        candidates.select("user_id", "item_id")
        .join(items.select("item_id", "item_category"), "item_id", "left")
        .select("user_id", "item_category").distinct()
    )


def user_category_aggregates(daily: DataFrame, needed: DataFrame) -> DataFrame:
    """A18-A19 raw aggregates for the needed (user, category) combinations (J2:
    log category against P's category; a null category matches nothing)."""
    per_item = daily.groupBy("user_id", "item_category", "item_id").agg(F.sum("n").alias("n"))
    per_category = per_item.groupBy("user_id", "item_category").agg(
        F.sum("n").alias("user_category_actions"),
        F.count("item_id").alias("user_category_items"),
    )
    return per_category.join(needed, ["user_id", "item_category"], "left_semi")


def user_category_columns() -> list:
    return [_z("user_category_actions").alias("user_category_actions"),
            _z("user_category_items").alias("user_category_items")]


def _p_categories(items: DataFrame, dedupe_items: bool) -> DataFrame:
    cats = items.select("item_id", "item_category")
    return cats.distinct() if dedupe_items else cats


def user_features(candidates: DataFrame, daily: DataFrame, ref) -> DataFrame:
    """A1-A8 + J7: one row per candidate user, defaults for inactive users."""
    users = candidates.select("user_id").distinct()
    return users.join(user_aggregates(daily, ref), "user_id", "left").select("user_id", *user_columns(ref))


def item_features(candidates: DataFrame, daily: DataFrame, items: DataFrame, ref,
                  dedupe_items: bool = False) -> DataFrame:
    """A9-A14 + J4: one row per candidate item, then P's category by a left join.

    With ``dedupe_items=False`` an item listed twice in P yields two rows
    (the original fan-out); ``True`` keeps one row per (item, category).
    """
    cand_items = candidates.select("item_id").distinct()
    base = cand_items.join(item_aggregates(daily, candidates, ref), "item_id", "left") \
        .select("item_id", *item_columns(ref))
    return base.join(_p_categories(items, dedupe_items), "item_id", "left")


def pair_features(candidates: DataFrame, daily: DataFrame, ref) -> DataFrame:
    """A15-A17 + J7: one row per distinct candidate pair."""
    keys = candidates.select("user_id", "item_id").distinct()
    return keys.join(pair_aggregates(daily), ["user_id", "item_id"], "left") \
        .select("user_id", "item_id", *pair_columns(ref))


def user_category_features(candidates: DataFrame, daily: DataFrame, items: DataFrame) -> DataFrame:
    """Per needed (user, category): actions and distinct items (0 if none)."""
    needed = needed_user_categories(candidates, items)
    return needed.join(user_category_aggregates(daily, needed), ["user_id", "item_category"], "left") \
        .select("user_id", "item_category", *user_category_columns())


def grain_population(grain: DataFrame, items: DataFrame, candidates: DataFrame, ref) -> DataFrame:
    """F5 + F1 + F2 on a pre-aggregated grain table (see ``streaming.daily_grain``)."""
    g = grain.where(F.col("dt") < lit_date(_d(ref)))
    g = g.join(item_set(items), "item_id", "left_semi")
    return g.join(candidates.select("user_id").distinct(), "user_id", "left_semi")


def build_features(actions: DataFrame | None, items: DataFrame, candidates: DataFrame, ref,
                   dedupe_items: bool = False, materialize_daily: bool = True,
                   grain: DataFrame | None = None) -> DataFrame:
    """A20 + A21 + J3-J6: the wide feature table for one candidate set.

    Reads the raw log (``actions``) or, with ``grain=``, the day-partial table
    maintained by ``streaming.daily_grain``.

    Columns: ``user_id, item_id, [label]`` then the 32 features. The raw
    aggregates are left-joined onto the candidate rows and every default
    (0 / 999 / span 0 / ratio 0) is applied in one projection. Join order:
    pair (same key as the candidates), item, P's category (may fan out), then
    one table holding the user and user-category aggregates per needed
    (user, category). AQE picks broadcast or sort-merge per join from runtime
    sizes and splits skewed keys.
    """
    ref = _d(ref)
    if grain is not None:
        # Day partials kept by the grain stream: the compact table stands in
        # for the log (split rows of one key are fine for every aggregate).
        daily = grain_population(grain, items, candidates, ref)
    else:
        # Four aggregates read the daily grain: write it once rather than scan
        # the log four times. Bucketed by pair, it gives the pair aggregates and
        # their join without a shuffle; hot users and items stay spread, and the
        # other aggregates combine before their shuffle.
        daily = feature_population(actions, items, candidates, ref)
        daily = materialize_bucketed(daily, "daily-grain", PAIR) if materialize_daily else daily

    id_cols = ["user_id", "item_id"] + (["label"] if "label" in candidates.columns else [])
    # User and user-category aggregates share one table keyed by the needed
    # (user, P-category) pairs, so the wide candidate rows take one shuffle
    # for both. A candidate outside P has a null category: matched null-safe,
    # it still gets its user features (and zero user-category counts).
    needed = needed_user_categories(candidates, items)
    per_user_cat = (
        needed.join(user_category_aggregates(daily, needed), ["user_id", "item_category"], "left")
        .join(user_aggregates(daily, ref), "user_id", "left")
        .withColumnRenamed("user_id", "_uc_user").withColumnRenamed("item_category", "_uc_cat")
    )
    j = (
        candidates.select(*id_cols)
        .join(pair_aggregates(daily), ["user_id", "item_id"], "left")
        .join(item_aggregates(daily, candidates, ref), "item_id", "left")
        .join(_p_categories(items, dedupe_items), "item_id", "left")
    )
    j = j.join(per_user_cat, (j["user_id"] == per_user_cat["_uc_user"])
               & j["item_category"].eqNullSafe(per_user_cat["_uc_cat"]), "left")
    return j.select(
        *id_cols,
        *user_columns(ref),
        *item_columns(ref),
        F.coalesce(F.col("item_category"), F.lit(0)).cast("bigint").alias("item_category"),
        *pair_columns(ref),
        *user_category_columns(),
    )


def feature_columns(df: DataFrame, exclude=(), drop_time_gaps: bool = False) -> list[str]:
    """F13 + F14: all columns but ids/label, minus exclusions."""
    from cartwheel.schemas import TIME_GAP_FEATURES
    drop = set(exclude)
    if drop_time_gaps:
        drop |= set(TIME_GAP_FEATURES)
    return [c for c in df.columns if c not in ("user_id", "item_id", "label") and c not in drop]


__all__ = [
    "reference_day", "feature_population", "grain_population", "daily_grain", "user_aggregates", "item_aggregates",
    "pair_aggregates", "user_category_aggregates", "user_features", "item_features", "pair_features",
    "user_category_features", "needed_user_categories", "build_features", "feature_columns",
    "FEATURE_COLUMNS", "USER_FEATURES", "ITEM_FEATURES", "PAIR_FEATURES", "USER_CATEGORY_FEATURES", "NEVER_DAYS",
]

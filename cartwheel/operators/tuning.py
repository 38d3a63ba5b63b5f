"""Strategy evaluation and tuning on labelled, scored rows: E8-E15.

Rows: ``user_id, item_id, label, pred_prob`` plus the strong-rule columns.
The (K, m) grid and the threshold grid are each evaluated in *one* pass:
rows are ranked once (top 15 per user and strong flag), and every grid point
is a pair of conditional sums in a single aggregate -- no cross join, no
per-point re-scan. Grid winners are chosen from a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.exprs import strong_rule, with_missing_as_zero
from cartwheel.operators import sampling
from cartwheel.operators import strategies as st
from cartwheel.operators.metrics import f1_row, threshold_counts
from cartwheel.schemas import (
    STRONG_RULE_COLUMNS, THRESHOLD_GRID_POINTS, THRESHOLD_GRID_QUANTILES,
    TWO_STAGE_K_GRID, TWO_STAGE_M_GRID,
)


def with_strong_flag(df: DataFrame) -> DataFrame:
    """F16 + F8 per row: missing rule columns become 0, then ``is_strong``."""
    df = with_missing_as_zero(df, STRONG_RULE_COLUMNS)
    return df.withColumn("is_strong", strong_rule(df))


def counts_of(selected: DataFrame, population: DataFrame) -> DataFrame:
    """One row ``tp, pred_cnt, true_pos``: picks and hits of ``selected``,
    positives of ``population``; one union + aggregate (no join)."""
    lab = F.coalesce(F.col("label"), F.lit(0)).cast("bigint")
    marks = selected.select(F.lit(1).cast("bigint").alias("_c"), lab.alias("_t"), F.lit(0).cast("bigint").alias("_p"))
    alls = population.select(F.lit(0).cast("bigint").alias("_c"), F.lit(0).cast("bigint").alias("_t"), lab.alias("_p"))
    return marks.unionByName(alls).agg(
        F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("tp"),
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("pred_cnt"),
        F.coalesce(F.sum("_p"), F.lit(0)).cast("bigint").alias("true_pos"),
    )


def grid_two_stage(df: DataFrame, k_grid=TWO_STAGE_K_GRID, m_grid=TWO_STAGE_M_GRID) -> DataFrame:
    """E8 over the grid (E12): ``grid_idx, k, m, tp, pred_cnt, true_pos, f1, precision, recall``.

    Points with m > k are skipped (29 points for the default grids).
    """
    points = [(k, m) for k in k_grid for m in m_grid if m <= k]
    flagged = with_strong_flag(df)
    ranked = st.two_stage_ranked(flagged, max(k_grid))
    lab = F.coalesce(F.col("label"), F.lit(0)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    marks, alls = [], []
    for i, (k, m) in enumerate(points):
        keep = st.two_stage_keep(int(k), int(m))
        marks += [F.when(keep, 1).otherwise(0).cast("bigint").alias(f"c{i}"),
                  F.when(keep, lab).otherwise(0).cast("bigint").alias(f"t{i}")]
        alls += [zero.alias(f"c{i}"), zero.alias(f"t{i}")]
    both = ranked.select(*marks, zero.alias("_p")).unionByName(flagged.select(*alls, lab.alias("_p")))
    one = both.agg(*[F.sum(c).alias(c) for i in range(len(points)) for c in (f"c{i}", f"t{i}")],
                   F.sum("_p").alias("true_pos"))
    rows = F.array(*[
        F.struct(F.lit(i).alias("grid_idx"), F.lit(int(k)).alias("k"), F.lit(int(m)).alias("m"),
                 F.col(f"t{i}").alias("tp"), F.col(f"c{i}").alias("pred_cnt"))
        for i, (k, m) in enumerate(points)
    ])
    long = one.select(F.explode(rows).alias("g"), "true_pos").select("g.*", "true_pos")
    return f1_row(long)


def eval_two_stage(df: DataFrame, k: int, m: int) -> DataFrame:
    """Micro F1 of K2 with (k, m) on labelled rows; one row."""
    return grid_two_stage(df, (int(k),), (int(m),)).drop("grid_idx")


def eval_threshold(df: DataFrame, threshold: float) -> DataFrame:
    """Micro F1 of the threshold rule; one row."""
    return f1_row(threshold_counts(df, threshold))


def eval_cart_only(df: DataFrame, days_max: int = 1, min_prob: float = 0.0,
                   max_submission: int | None = 0) -> DataFrame:
    """Fixed window cart rule, optional min_prob and cap; recall over all
    positives of the input. One row ``tp, pred_cnt, true_pos, f1, precision, recall``."""
    sel = st.cart_only_fixed(df, days_max=days_max, min_prob=min_prob, max_submission=max_submission)
    return f1_row(counts_of(sel, df))


def threshold_grid_values(df: DataFrame, points: int = THRESHOLD_GRID_POINTS,
                          qs=THRESHOLD_GRID_QUANTILES) -> list[float]:
    """E13 grid: ``linspace(q_low, q_high, points)`` of exact score quantiles."""
    qv = st.exact_quantiles(df, "pred_prob", list(qs)).first()
    lo, hi = qv["q0"], qv["q1"]
    if lo is None:
        return []
    if points == 1:
        return [float(lo)]
    step = (hi - lo) / (points - 1)
    vals = [lo + i * step for i in range(points)]
    vals[-1] = hi
    return [float(v) for v in vals]


def grid_threshold(df: DataFrame, points: int = THRESHOLD_GRID_POINTS) -> DataFrame:
    """Every grid threshold in one aggregate: ``grid_idx, threshold, tp,
    pred_cnt, true_pos, q_level, f1, precision, recall``."""
    grid = threshold_grid_values(df, points)
    if not grid:
        return df.sparkSession.createDataFrame(
            [], "grid_idx int, threshold double, tp bigint, pred_cnt bigint, true_pos bigint, "
                "q_level double, f1 double, precision double, recall double")
    aggs = [F.count(F.lit(1)).alias("_n"),
            F.coalesce(F.sum("label"), F.lit(0)).cast("bigint").alias("true_pos")]
    for i, t in enumerate(grid):
        sel = F.col("pred_prob") >= F.lit(t)
        aggs.append(F.count(F.when(sel, 1)).alias(f"c{i}"))
        aggs.append(F.coalesce(F.sum(F.when(sel, F.col("label"))), F.lit(0)).cast("bigint").alias(f"t{i}"))
    one = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(i).alias("grid_idx"), F.lit(t).alias("threshold"),
                 F.col(f"t{i}").alias("tp"), F.col(f"c{i}").alias("pred_cnt"))
        for i, t in enumerate(grid)
    ])
    long = one.select(F.explode(rows).alias("g"), "true_pos", "_n").select(
        "g.*", "true_pos", (F.col("g.pred_cnt").cast("double") / F.col("_n")).alias("q_level"))
    return f1_row(long)


def best_of(grid: DataFrame) -> dict | None:
    """First best F1 in grid order (strict improvement), from <= 29 rows."""
    best = None
    for r in grid.orderBy("grid_idx").collect():
        if best is None or r["f1"] > best["f1"]:
            best = r.asDict()
    return best


def choose_strategy(df: DataFrame) -> dict:
    """E12 + E13 + E14: two-stage if its best F1 >= the best threshold F1,
    else threshold with the quantile level and the best (k, m) as fallback.
    An empty sample gives two-stage (5, 1)."""
    if df.limit(1).count() == 0:
        return {"name": "topk_two_stage", "k": 5, "m": 1, "fallback": None, "f1": 0.0}
    top = best_of(grid_two_stage(df))
    thr = best_of(grid_threshold(df))
    if thr is None or top["f1"] >= thr["f1"]:
        return {"name": "topk_two_stage", "k": int(top["k"]), "m": int(top["m"]), "fallback": None,
                "f1": float(top["f1"])}
    return {"name": "threshold", "threshold": float(thr["threshold"]), "q_level": float(thr["q_level"]),
            "fallback": {"k": int(top["k"]), "m": int(top["m"])}, "f1": float(thr["f1"])}


def strategy_row(df: DataFrame, strategy: dict) -> DataFrame:
    """E14 as a one-row DataFrame derived from the data."""
    fb = strategy.get("fallback") or {}
    return df.sparkSession.range(1).select(
        F.lit(strategy["name"]).alias("name"),
        F.lit(strategy.get("k")).cast("int").alias("k"),
        F.lit(strategy.get("m")).cast("int").alias("m"),
        F.lit(strategy.get("threshold")).cast("double").alias("threshold"),
        F.lit(strategy.get("q_level")).cast("double").alias("q_level"),
        F.lit(fb.get("k")).cast("int").alias("fallback_k"),
        F.lit(fb.get("m")).cast("int").alias("fallback_m"),
    )


def eval_forced(df: DataFrame, strategy: dict, sample_user_frac: float | None = None, min_prob: float = 0.0,
                max_submission: int | None = 0, strong_only: bool = False, cart_days_max: int = 1,
                topn: int | None = None, seed: int = 42, sample_floor: int = 0) -> DataFrame:
    """Evaluate the active strategy on all users, or on a user sample
    where a share is given. One row ``strategy, users, tp, pred_cnt, true_pos,
    f1, precision, recall``."""
    sdf = df if sample_user_frac is None else sampling.user_sample(df, sample_user_frac, seed, sample_floor)
    sdf = with_strong_flag(sdf)
    if strong_only:
        sdf = sdf.where(F.col("is_strong"))
    name = st.normalize_strategy(strategy.get("name"))
    if name == "topk_two_stage":
        k, m = int(strategy["k"]), int(strategy["m"])
        ranked = st.two_stage_ranked(sdf, k)
        sel = ranked.where(st.two_stage_keep(k, m))
        if min_prob and float(min_prob) > 0:
            sel = sel.where(F.col("pred_prob") >= F.lit(float(min_prob)))
        sel = st.take_first(sel.drop("rn", "n_strong"), max_submission, st.score_order(), score_col="pred_prob")
        counts = counts_of(sel, sdf)
    elif name == "threshold":
        counts = threshold_counts(sdf, float(strategy.get("threshold", 0.5)))
    elif name == "global_topn":
        counts = counts_of(st.take_first(sdf, topn, st.score_order(), score_col="pred_prob"), sdf)
    elif name == "cart_only":
        counts = eval_cart_only(sdf, days_max=cart_days_max, min_prob=min_prob,
                                max_submission=max_submission).select("tp", "pred_cnt", "true_pos")
    else:
        raise ValueError(f"unknown strategy {strategy.get('name')!r}")
    n_users = sdf.select("user_id").distinct().count()   # one number
    return f1_row(counts.select("tp", "pred_cnt", "true_pos")).select(
        F.lit(name).alias("strategy"), F.lit(int(n_users)).cast("bigint").alias("users"),
        "tp", "pred_cnt", "true_pos", "f1", "precision", "recall")


def full_validation(scored_rows: DataFrame, features: DataFrame, strategy: dict,
                    strong_only: bool = False, min_prob=None, topn: int | None = None,
                    max_rows: int | None = None, cart_days_max: int = 3) -> DataFrame:
    """Per pair max score and max label (A23), pre-filters, the strategy,
    then F1 over all positives via a label lookup (J13). One row."""
    res_v = scored_rows.groupBy("user_id", "item_id").agg(
        F.max("pred_prob").alias("pred_prob"), F.max("label").alias("label"))
    res = st.prefilter(res_v.select("user_id", "item_id", "pred_prob"), features, strong_only, min_prob)
    name = st.normalize_strategy(strategy.get("name"))
    strat = dict(strategy)
    if name == "threshold":
        strat = {"name": "threshold", "threshold": strategy.get("threshold", 0.5)}  # no quantile shift
    recs = st.select_by_strategy(strat, res, features, topn=topn, max_rows=max_rows,
                                 cart_days_max=cart_days_max, threshold_fallback=False)
    labelled = recs.join(res_v.select("user_id", "item_id", "label"), ["user_id", "item_id"], "left")
    return f1_row(counts_of(labelled, res_v))

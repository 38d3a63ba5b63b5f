"""Offline evaluation: E1-E7, E16, A24-A26.

Inputs are ``user_id, item_id, label, pred_prob`` rows. Per-user ranks use a
literal-limit ``row_number`` (partial group limit before the shuffle); per-user
positives come from a partially aggregated ``groupBy``; AUC ranks the distinct
scores with a distributed cumulative sum. Averages over users are one global
aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.ranking import global_cum_sum, top_k_per_group

DEFAULT_KS = (1, 3, 5, 10)
METRIC_ORDER = ("precision", "recall", "f1", "hit_ratio", "ndcg")


def f1_exprs(tp: Column, pred_cnt: Column, true_pos: Column) -> tuple[Column, Column, Column]:
    """(f1, precision, recall); all three 0 if nothing was predicted or
    there is no positive."""
    valid = (pred_cnt > 0) & (true_pos > 0)
    p = F.when(valid, tp.cast("double") / pred_cnt.cast("double")).otherwise(F.lit(0.0))
    r = F.when(valid, tp.cast("double") / true_pos.cast("double")).otherwise(F.lit(0.0))
    f1 = F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))
    return f1, p, r


def f1_row(counts: DataFrame) -> DataFrame:
    """E1 on a frame with ``tp, pred_cnt, true_pos``: adds ``f1, precision, recall``."""
    f1, p, r = f1_exprs(F.col("tp"), F.col("pred_cnt"), F.col("true_pos"))
    return counts.select("*", f1.alias("f1"), p.alias("precision"), r.alias("recall"))


def threshold_counts(df: DataFrame, threshold: float) -> DataFrame:
    """Counts of the threshold rule (E9): one row ``tp, pred_cnt, true_pos``."""
    sel = F.col("pred_prob") >= F.lit(float(threshold))
    return df.agg(
        F.count(F.when(sel, 1)).alias("pred_cnt"),
        F.coalesce(F.sum(F.when(sel, F.col("label"))), F.lit(0)).cast("bigint").alias("tp"),
        F.coalesce(F.sum("label"), F.lit(0)).cast("bigint").alias("true_pos"),
    )


def auc(df: DataFrame, label: str = "label", score: str = "pred_prob") -> DataFrame:
    """ROC-AUC with ties counted half (rank-sum); null when a class is empty.

    ``sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)`` over distinct scores.
    """
    by_score = df.groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("bigint").alias("_neg"),
    )
    cum = global_cum_sum(by_score, [F.col("_s")], "_neg", "_neg_below")
    agg = cum.agg(
        F.sum(F.col("_pos").cast("double") * (F.col("_neg_below").cast("double") + F.col("_neg") / 2.0)).alias("_num"),
        F.sum("_pos").alias("_P"),
        F.sum("_neg").alias("_N"),
    )
    return agg.select(
        F.when((F.col("_P") > 0) & (F.col("_N") > 0),
               F.col("_num") / (F.col("_P").cast("double") * F.col("_N").cast("double"))).alias("auc"))


def _ideal_dcg(k: int, npos: Column) -> Column:
    """sum_{i=1..min(k, npos)} 1 / log2(i + 1) for binary labels."""
    n = F.least(F.lit(int(k)), npos).cast("int")
    return F.when(n > 0, F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0.0),
        lambda acc, i: acc + F.lit(1.0) / F.log2(i.cast("double") + 1.0))).otherwise(F.lit(0.0))


def per_user_at_k(df: DataFrame, ks: Sequence[int] = DEFAULT_KS) -> DataFrame:
    """Per-user precision/recall/hit/ndcg at each k (columns ``p_k, r_k, h_k, n_k``)."""
    kmax = max(ks)
    ranked = top_k_per_group(df, ["user_id"], [F.col("pred_prob").desc(), F.col("item_id")], kmax)
    y = F.col("label").cast("double")
    aggs = []
    for k in ks:
        inside = F.col("rn") <= F.lit(int(k))
        aggs.append(F.sum(F.when(inside, y).otherwise(0.0)).alias(f"hits_{k}"))
        aggs.append(F.sum(F.when(inside, y / F.log2(F.col("rn").cast("double") + 1.0)).otherwise(0.0)).alias(f"dcg_{k}"))
    top = ranked.groupBy("user_id").agg(*aggs)
    npos = df.groupBy("user_id").agg(F.sum(F.col("label").cast("double")).alias("npos"))
    j = npos.join(top, "user_id", "left")
    cols = ["user_id"]
    for k in ks:
        hits = F.coalesce(F.col(f"hits_{k}"), F.lit(0.0))
        dcg = F.coalesce(F.col(f"dcg_{k}"), F.lit(0.0))
        idcg = _ideal_dcg(k, F.col("npos").cast("bigint"))
        cols += [
            (hits / F.lit(float(k))).alias(f"p_{k}"),
            F.when(F.col("npos") > 0, hits / F.col("npos")).otherwise(0.0).alias(f"r_{k}"),
            F.when(hits > 0, 1.0).otherwise(0.0).alias(f"h_{k}"),
            F.when(idcg > 0, dcg / idcg).otherwise(0.0).alias(f"n_{k}"),
        ]
    return j.select(*cols)


def ranking_metrics(df: DataFrame, ks: Sequence[int] = DEFAULT_KS) -> DataFrame:
    """One row per k: ``k, precision, recall, f1, hit_ratio, ndcg``
    (means over all users; f1 from the mean precision and recall)."""
    pu = per_user_at_k(df, ks)
    aggs = []
    for k in ks:
        aggs += [F.avg(f"p_{k}").alias(f"p_{k}"), F.avg(f"r_{k}").alias(f"r_{k}"),
                 F.avg(f"h_{k}").alias(f"h_{k}"), F.avg(f"n_{k}").alias(f"n_{k}")]
    one = pu.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(int(k)).alias("k"), F.col(f"p_{k}").alias("precision"), F.col(f"r_{k}").alias("recall"),
                 F.col(f"h_{k}").alias("hit_ratio"), F.col(f"n_{k}").alias("ndcg"))
        for k in ks
    ])
    long = one.select(F.explode(rows).alias("m")).select("m.*")
    p, r = F.col("precision"), F.col("recall")
    return long.select(
        "k", "precision", "recall",
        F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1"),
        "hit_ratio", "ndcg",
    )


def metric_report(df: DataFrame, ks: Sequence[int] = DEFAULT_KS) -> DataFrame:
    """Long report ``metric, k, value`` (AUC with k = 0)."""
    wide = ranking_metrics(df, ks)
    stacked = wide.select("k", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRIC_ORDER
    ])).alias("x")).select(F.col("x.metric").alias("metric"), "k", F.col("x.value").alias("value"))
    a = auc(df).select(F.lit("auc").alias("metric"), F.lit(0).alias("k"), F.col("auc").alias("value"))
    return stacked.unionByName(a)


def fold_report(oof: DataFrame, k: int = 5) -> DataFrame:
    """Per fold: ``fold, auc, precision, recall, f1`` (the last three at ``k``,
    means over the fold's users; a user lies in one fold or is ranked in each)."""
    ranked = top_k_per_group(oof, ["fold", "user_id"], [F.col("pred_prob").desc(), F.col("item_id")], k)
    y = F.col("label").cast("double")
    hits = ranked.groupBy("fold", "user_id").agg(F.sum(y).alias("hits"))
    users = (oof.groupBy("fold", "user_id").agg(F.sum(y).alias("npos")).join(hits, ["fold", "user_id"]).groupBy("fold")
             .agg(F.avg(F.col("hits") / F.lit(float(k))).alias("precision"),
                  F.avg(F.when(F.col("npos") > 0, F.col("hits") / F.col("npos")).otherwise(0.0)).alias("recall")))
    p, r = F.col("precision"), F.col("recall")
    users = users.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)))
    by_score = oof.groupBy("fold", F.col("pred_prob").alias("s")).agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("pos"), F.count(F.when(F.col("label") != 1, 1)).alias("neg"))
    # Distinct scores of all folds in one order: what lies below in a fold is the sum before it, less the fold's start.
    cum = global_cum_sum(by_score, ["fold", "s"], "neg", "below")
    start = cum.groupBy("fold").agg(F.min("below").alias("start"))
    sums = cum.join(F.broadcast(start), "fold").groupBy("fold").agg(
        F.sum(F.col("pos") * (F.col("below") - F.col("start") + F.col("neg") / 2)).alias("wins"),
        F.sum("pos").cast("double").alias("P"), F.sum("neg").alias("N"))
    auc_ = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("wins") / (F.col("P") * F.col("N")))
    return sums.select("fold", auc_.alias("auc")).join(users, "fold").select("fold", "auc", "precision", "recall", "f1")


def score_summary(df: DataFrame, threshold: float) -> DataFrame:
    """Share of scores >= t, positive rate, distinct users; one row."""
    return df.agg(
        F.avg(F.when(F.col("pred_prob") >= F.lit(float(threshold)), 1.0).otherwise(0.0)).alias("share_ge_t"),
        F.avg(F.col("label").cast("double")).alias("pos_rate"),
        F.countDistinct("user_id").alias("users"),
    )


def feature_importance(importance: DataFrame) -> DataFrame:
    """Raw gain summed over folds, largest first (small frame)."""
    return importance.groupBy("feature").agg(F.sum("importance").alias("importance")) \
        .orderBy(F.col("importance").desc(), F.col("feature"))

"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

bridged tables of a scale factor; ``oracle.ORACLE`` holds the matching SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.exprs import stand_in_score
from cartwheel.operators import features as feat
from cartwheel.operators import metrics as mx
from cartwheel.operators import recall
from cartwheel.operators import sampling as sm
from cartwheel.operators import scoring as sc
from cartwheel.operators import strategies as st
from cartwheel.operators import tuning as tn
from cartwheel.plans import fixture as fx
from cartwheel.plans.params import Params
from cartwheel.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- sources / filters (S1-S4, F1, F4-F7) ----
@register("actions_bridge")
def q_actions_bridge(spark, sf):
    return fx.load(spark, sf).actions.select("user_id", "item_id", "behavior_type", "item_category", "dt")


@register("target_items")
def q_target_items(spark, sf):
    return fx.load(spark, sf).items


@register("actions_in_target")
def q_actions_in_target(spark, sf):
    inp = fx.load(spark, sf)
    return recall.in_target(inp.actions, inp.items).select(
        "user_id", "item_id", "behavior_type", "item_category", "dt")


@register("buys_on_day")
def q_buys_on_day(spark, sf):
    inp = fx.load(spark, sf)
    return recall.buys_on_day(inp.actions, inp.label_date)


# ---- recall (C1-C8, U1-U3) ----
@register("recall_recent")
def q_recall_recent(spark, sf):
    return recall.recall_recent(fx.load(spark, sf).lazy_flags())


@register("recall_strong")
def q_recall_strong(spark, sf):
    return recall.recall_strong(fx.load(spark, sf).lazy_flags())


@register("recall_union")
def q_recall_union(spark, sf):
    return recall.recall_union(fx.load(spark, sf).lazy_flags())


@register("label_pairs")
def q_label_pairs(spark, sf):
    return recall.label_pairs(fx.load(spark, sf).lazy_flags())


@register("label_pairs_aligned")
def q_label_pairs_aligned(spark, sf):
    return recall.label_pairs_aligned(fx.load(spark, sf).lazy_flags())


@register("label_pairs_dropped")
def q_label_pairs_dropped(spark, sf):
    return recall.label_pairs_dropped(fx.load(spark, sf).lazy_flags())


@register("train_candidates")
def q_train_candidates(spark, sf):
    return fx.load(spark, sf).train_candidates(lazy=True)


@register("train_candidates_unaligned")
def q_train_candidates_unaligned(spark, sf):
    return fx.load(spark, sf).train_candidates(align=False, lazy=True)


@register("pred_candidates")
def q_pred_candidates(spark, sf):
    return fx.load(spark, sf).pred_candidates(lazy=True)


@register("candidates_capped")
def q_candidates_capped(spark, sf):
    return fx.load(spark, sf).train_candidates(cap=fx.CAP_BINDING, lazy=True)


@register("hot_items")
def q_hot_items(spark, sf):
    inp = fx.load(spark, sf)
    return recall.hot_items(inp.actions, inp.items, inp.label_date, top=fx.HOT_TOP)


@register("pred_candidates_backfilled")
def q_pred_candidates_backfilled(spark, sf):
    inp = fx.load(spark, sf)
    hot = recall.hot_items(inp.actions, inp.items, inp.label_date, top=fx.HOT_TOP_BACKFILL)
    return recall.backfill_hot(inp.pred_candidates(cap=fx.CAP_BACKFILL, lazy=True), hot,
                               max_per_user=fx.CAP_BACKFILL)


@register("candidate_stats")
def q_candidate_stats(spark, sf):
    return recall.candidate_stats(fx.load(spark, sf).train_candidates())


# ---- features (A1-A21, J1-J7) ----
def _train_blocks(spark, sf):
    inp = fx.load(spark, sf)
    cands = inp.train_candidates()
    daily = feat.feature_population(inp.actions, inp.items, cands, inp.train_ref)
    return inp, cands, materialize(daily, "daily-grain")


@register("user_features")
def q_user_features(spark, sf):
    inp, cands, daily = _train_blocks(spark, sf)
    return feat.user_features(cands, daily, inp.train_ref)


@register("item_features")
def q_item_features(spark, sf):
    inp, cands, daily = _train_blocks(spark, sf)
    return feat.item_features(cands, daily, inp.items, inp.train_ref)


@register("pair_features")
def q_pair_features(spark, sf):
    inp, cands, daily = _train_blocks(spark, sf)
    return feat.pair_features(cands, daily, inp.train_ref)


@register("user_category_features")
def q_user_category_features(spark, sf):
    inp, cands, daily = _train_blocks(spark, sf)
    return feat.user_category_features(cands, daily, inp.items)


@register("train_features")
def q_train_features(spark, sf):
    return fx.load(spark, sf).train_features(lazy=True)


@register("pred_features")
def q_pred_features(spark, sf):
    return fx.load(spark, sf).pred_features(lazy=True)


@register("train_features_fanout")
def q_train_features_fanout(spark, sf):
    inp = fx.load(spark, sf)
    return inp.train_features(items=inp.items_fanout, lazy=True)


# ---- strategies (F8-F11, K1-K10, J8-J12, A22, A25) ----


def _pred(spark, sf):
    """(inputs, predict features, results) with the stand-in score."""
    inp = fx.load(spark, sf)
    pf = inp.pred_features()
    results = st.dedupe_results(pf.withColumn("pred_prob", _score()))
    return inp, pf, results


def _score():
    return stand_in_score()


def _scored_train(spark, sf):
    """Train features with label and the stand-in score."""
    return fx.load(spark, sf).train_features().withColumn("pred_prob", _score())


@register("strong_pairs")
def q_strong_pairs(spark, sf):
    _, pf, _ = _pred(spark, sf)
    return st.strong_pairs(pf)


@register("prefilter_strong")
def q_prefilter_strong(spark, sf):
    _, pf, res = _pred(spark, sf)
    return st.prefilter(res, pf, strong_only=True)


@register("prefilter_min_prob")
def q_prefilter_min_prob(spark, sf):
    _, pf, res = _pred(spark, sf)
    return st.prefilter(res, pf, strong_only=True, min_prob="0.3")


@register("result_dedup")
def q_result_dedup(spark, sf):
    inp = fx.load(spark, sf)
    tf = inp.train_features(items=inp.items_fanout).withColumn("pred_prob", _score())
    return st.dedupe_results(tf)


@register("topk_per_user")
def q_topk_per_user(spark, sf):
    _, _, res = _pred(spark, sf)
    return st.topk_per_user(res, 5)


@register("two_stage")
def q_two_stage(spark, sf):
    _, pf, res = _pred(spark, sf)
    return st.two_stage(res, st.strong_pairs(pf), k=3, m=1)


@register("threshold_select")
def q_threshold_select(spark, sf):
    _, _, res = _pred(spark, sf)
    return st.threshold_select(res, 0.5)


@register("global_topn")
def q_global_topn(spark, sf):
    _, _, res = _pred(spark, sf)
    return st.global_topn(res, 100)


@register("cart_only")
def q_cart_only(spark, sf):
    _, pf, res = _pred(spark, sf)
    return st.cart_only(pf, res, cart_days_max=2)


@register("cart_only_relaxed")
def q_cart_only_relaxed(spark, sf):
    _, pf, res = _pred(spark, sf)
    return st.cart_only(pf, res, cart_days_max=3)


@register("cart_only_capped")
def q_cart_only_capped(spark, sf):
    """K4 with a cap that the first window reaches."""
    _, pf, res = _pred(spark, sf)
    return st.cart_only(pf, res, max_rows=fx.CART_MAX_ROWS, cart_days_max=3)


@register("cap_submission")
def q_cap_submission(spark, sf):
    _, pf, res = _pred(spark, sf)
    recs = st.two_stage(res, st.strong_pairs(pf), k=5, m=1)
    return st.cap_submission(recs, res, fx.SUBMISSION_CAP)


@register("exclude_day_buys")
def q_exclude_day_buys(spark, sf):
    inp, pf, res = _pred(spark, sf)
    recs = st.two_stage(res, st.strong_pairs(pf), k=5, m=1)
    return st.exclude_day_buys(recs, inp.actions, inp.label_date)


@register("submission")
def q_submission(spark, sf):
    """K10 with the INI setup: strong_only, min_prob 0.09, cart_only (window 1),
    then the day exclusion and a cap."""
    inp, pf, res = _pred(spark, sf)
    pre = st.prefilter(res, pf, strong_only=True, min_prob=0.09)
    recs = st.select_by_strategy({"name": "cart"}, pre, pf, cart_days_max=1)
    return st.post_chain(recs, pre, inp.actions, exclude_day=inp.label_date, max_submission=fx.SUBMISSION_CAP)


@register("threshold_by_quantile")
def q_threshold_by_quantile(spark, sf):
    _, _, res = _pred(spark, sf)
    return _r9(st.threshold_by_quantile(res, 0.1, 0.5))


@register("threshold_with_fallback")
def q_threshold_with_fallback(spark, sf):
    _, pf, res = _pred(spark, sf)
    return st.threshold_with_fallback(res, st.strong_pairs(pf), 2.0, fallback=(3, 1), min_rows=1)


@register("threshold_kept")
def q_threshold_kept(spark, sf):
    """K7's other branch: enough picks, no fallback."""
    _, pf, res = _pred(spark, sf)
    return st.threshold_with_fallback(res, st.strong_pairs(pf), 0.6, fallback=(3, 1), min_rows=1)


@register("score_quantiles")
def q_score_quantiles(spark, sf):
    _, _, res = _pred(spark, sf)
    q = st.exact_quantiles(res, "pred_prob", [0.5, 0.9, 0.999])
    return _r9(q.select(F.col("q0").alias("q50"), F.col("q1").alias("q90"), F.col("q2").alias("q999")))


# ---- metrics (E1-E7, E16, A26) ----
def _r9(df):
    """Round doubles to 9 digits (summation order differs between engines)."""
    return df.select(*[F.round(F.col(f.name), 9).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


@register("auc")
def q_auc(spark, sf):
    return _r9(mx.auc(_scored_train(spark, sf)))


@register("precision_recall_at_k")
def q_precision_recall_at_k(spark, sf):
    return _r9(mx.ranking_metrics(_scored_train(spark, sf)).select("k", "precision", "recall", "f1"))


@register("hit_ratio_at_k")
def q_hit_ratio_at_k(spark, sf):
    return _r9(mx.ranking_metrics(_scored_train(spark, sf)).select("k", "hit_ratio"))


@register("ndcg_at_k")
def q_ndcg_at_k(spark, sf):
    return _r9(mx.ranking_metrics(_scored_train(spark, sf)).select("k", "ndcg"))


@register("metric_report")
def q_metric_report(spark, sf):
    return _r9(mx.metric_report(_scored_train(spark, sf)))


@register("f1_counts")
def q_f1_counts(spark, sf):
    return _r9(mx.f1_row(mx.threshold_counts(_scored_train(spark, sf), 0.3)))


@register("score_summary")
def q_score_summary(spark, sf):
    return _r9(mx.score_summary(_scored_train(spark, sf), 0.5))


# ---- tuning (E8-E15) ----
@register("eval_two_stage")
def q_eval_two_stage(spark, sf):
    return _r9(tn.eval_two_stage(_scored_train(spark, sf), 3, 1))


@register("eval_threshold")
def q_eval_threshold(spark, sf):
    return _r9(tn.eval_threshold(_scored_train(spark, sf), 0.5))


@register("eval_cart_only")
def q_eval_cart_only(spark, sf):
    return _r9(tn.eval_cart_only(_scored_train(spark, sf), days_max=1, min_prob=0.09, max_submission=0))


@register("eval_forced")
def q_eval_forced(spark, sf):
    """E11 over all users: cart_only, strong_only, min_prob 0.09."""
    return _r9(tn.eval_forced(_scored_train(spark, sf), {"name": "cart_only"},
                              min_prob=0.09, strong_only=True, cart_days_max=1))


@register("eval_forced_topk")
def q_eval_forced_topk(spark, sf):
    return _r9(tn.eval_forced(_scored_train(spark, sf), {"name": "topk", "k": 3, "m": 1},
                              min_prob=0.3, max_submission=100))


@register("grid_two_stage")
def q_grid_two_stage(spark, sf):
    return _r9(tn.grid_two_stage(_scored_train(spark, sf)))


@register("grid_threshold")
def q_grid_threshold(spark, sf):
    return _r9(tn.grid_threshold(_scored_train(spark, sf)))


@register("chosen_strategy")
def q_chosen_strategy(spark, sf):
    df = _scored_train(spark, sf)
    return _r9(tn.strategy_row(df, tn.choose_strategy(df)))


@register("chosen_strategy_threshold")
def q_chosen_strategy_threshold(spark, sf):
    """E14's other branch: a score that knows the label makes the threshold win."""
    df = fx.load(spark, sf).train_features().withColumn(
        "pred_prob", _score() / 2 + F.col("label") * F.lit(0.5).cast("double"))
    return _r9(tn.strategy_row(df, tn.choose_strategy(df)))


@register("full_validation")
def q_full_validation(spark, sf):
    """Two-stage (5, 1) after the strong-only pre-filter, in-sample."""
    tf = fx.load(spark, sf).train_features()
    scored = tf.withColumn("pred_prob", _score())
    return _r9(tn.full_validation(scored, tf, {"name": "topk_two_stage", "k": 5, "m": 1}, strong_only=True))


# ---- sampling (N1-N9) ----
def _tf(spark, sf):
    return fx.load(spark, sf).train_features()


@register("neg_sample")
def q_neg_sample(spark, sf):
    return sm.downsample_negatives(_tf(spark, sf), neg_pos_ratio=20, seed=fx.SEED)


@register("neg_sample_by_user")
def q_neg_sample_by_user(spark, sf):
    return sm.downsample_negatives(_tf(spark, sf), neg_pos_ratio=5, seed=fx.SEED, by_user=True)


@register("neg_sample_bucketed")
def q_neg_sample_bucketed(spark, sf):
    return sm.downsample_negatives_bucketed(_tf(spark, sf), neg_pos_ratio=20, bounds=(1, 3, 7), seed=fx.SEED)


@register("neg_sample_chained")
def q_neg_sample_chained(spark, sf):
    return sm.downsample_chained(_tf(spark, sf), neg_pos_ratio=1, neg_max_gap_days=3, bounds=(1, 3, 7),
                                 seed=fx.SEED)


@register("user_sample")
def q_user_sample(spark, sf):
    return sm.user_sample(_tf(spark, sf), frac=fx.USER_SAMPLE_FRAC, seed=fx.SEED)


@register("balanced_sample")
def q_balanced_sample(spark, sf):
    return sm.balanced_sample(_tf(spark, sf), per_class=100, seed=fx.SEED)


@register("recency_bucket")
def q_recency_bucket(spark, sf):
    return sm.recency_bucket(_tf(spark, sf)).select("user_id", "item_id", "label", "bucket")


@register("group_kfold")
def q_group_kfold(spark, sf):
    return sm.group_kfold(_tf(spark, sf), 5, fx.SEED).select("user_id", "item_id", "label", "fold")


@register("stratified_kfold")
def q_stratified_kfold(spark, sf):
    return sm.stratified_kfold(_tf(spark, sf), 5, fx.SEED).select("user_id", "item_id", "label", "fold")


# ---- model scoring (M1-M9, A24): rows-only, checked by invariants in tests ----

MODEL_SPLITS = 3
MODEL_PATIENCE = 10           # rounds; the trees are the preset's at most


def _kfold(spark, sf):
    """The fold models of one data folder, trained once in a session."""
    inp = fx.load(spark, sf)
    if "kfold" not in inp._memo:
        tf = inp.train_features()
        inp._memo["kfold"] = sc.kfold_train_predict(
            tf, inp.pred_features(), feat.feature_columns(tf), n_splits=MODEL_SPLITS, group_kfold=True,
            seed=fx.SEED, preset="default", early_stopping=MODEL_PATIENCE)
    return inp._memo["kfold"]


@register("oof_scores")
def q_oof_scores(spark, sf):
    return _kfold(spark, sf).oof.select("user_id", "item_id", "label", "fold", "pred_prob")


@register("pred_scores")
def q_pred_scores(spark, sf):
    return st.dedupe_results(_kfold(spark, sf).pred.select("user_id", "item_id", "pred_prob"))


@register("feature_importance")
def q_feature_importance(spark, sf):
    return mx.feature_importance(_kfold(spark, sf).importance)


@register("pruned_features")
def q_pruned_features(spark, sf):
    imp = _kfold(spark, sf).importance
    return sc.pruned_features(imp)


@register("pca_embedding")
def q_pca_embedding(spark, sf):
    tf = fx.load(spark, sf).train_features()
    emb, _ = sc.pca_embedding(tf, feat.feature_columns(tf), per_class=Params.viz_sample_per_class, seed=fx.SEED)
    return emb


@register("model_nodes")
def q_model_nodes(spark, sf):
    """The folds' trees: feature, raw gain, rows and leaf value of every node."""
    return _kfold(spark, sf).nodes


@register("fold_history")
def q_fold_history(spark, sf):
    """M3: held-out AUC by iteration, and where each fold's ensemble is cut."""
    return sc.fold_history(_kfold(spark, sf))


@register("prune_retrain")
def q_prune_retrain(spark, sf):
    """M8: what is kept of the features, and whether the rule retrains."""
    res = _kfold(spark, sf)
    kept, dropped = sc.drop_zero_importance(res.importance, res.feature_cols)
    again = sc.should_retrain(kept, dropped, len(res.feature_cols))
    return sc.pruned_features(res.importance).withColumn("retrain", F.lit(again))


# ---- load-test log (lineitem join orders; performance and a second oracle) ----


def _load_inputs(spark, sf):
    return fx.load_orders(spark, sf)


@register("load_train_candidates")
def q_load_train_candidates(spark, sf):
    return _load_inputs(spark, sf).train_candidates(lazy=True)


@register("load_train_features")
def q_load_train_features(spark, sf):
    return _load_inputs(spark, sf).train_features(lazy=True)


@register("load_pred_features")
def q_load_pred_features(spark, sf):
    return _load_inputs(spark, sf).pred_features(lazy=True)


# ---- further variants: dedupe P, dispatch by alias, threshold strategy,
# feature exclusion, the other evaluation branches ----
@register("train_features_unaligned")
def q_train_features_unaligned(spark, sf):
    """Features of candidates that include positives without history."""
    inp = fx.load(spark, sf)
    return feat.build_features(inp.actions, inp.items, inp.train_candidates(align=False), inp.train_ref)


@register("pred_features_backfilled")
def q_pred_features_backfilled(spark, sf):
    """Features of backfilled candidates: pairs that never met (gap 999)."""
    inp = fx.load(spark, sf)
    return feat.build_features(inp.actions, inp.items, q_pred_candidates_backfilled(spark, sf), inp.pred_ref)


@register("train_features_dedup")
def q_train_features_dedup(spark, sf):
    """Q3 with ``dedupe_items=True``: one row per candidate despite repeats in P."""
    inp = fx.load(spark, sf)
    return inp.train_features(items=inp.items_fanout, dedupe_items=True, lazy=True)


@register("strategy_dispatch")
def q_strategy_dispatch(spark, sf):
    """K9: the alias '2stage' dispatches to two-stage (k=5, m=2)."""
    _, pf, res = _pred(spark, sf)
    return st.select_by_strategy({"name": "2stage", "k": 5, "m": 2}, res, pf)


@register("threshold_strategy")
def q_threshold_strategy(spark, sf):
    """K6 as dispatched: threshold moved to the 1 - q_level quantile of the
    predict scores."""
    _, pf, res = _pred(spark, sf)
    return st.select_by_strategy({"name": "threshold", "threshold": 0.5, "q_level": 0.3,
                                  "fallback": {"k": 3, "m": 1}}, res, pf)


@register("train_features_no_time_gaps")
def q_train_features_no_time_gaps(spark, sf):
    """the six time-gap features removed from the training columns."""
    tf = fx.load(spark, sf).train_features()
    keep = feat.feature_columns(tf, drop_time_gaps=True)
    return tf.select("user_id", "item_id", "label", *keep)


@register("eval_forced_threshold")
def q_eval_forced_threshold(spark, sf):
    return _r9(tn.eval_forced(_scored_train(spark, sf), {"name": "thr", "threshold": 0.5}))


@register("eval_forced_topn")
def q_eval_forced_topn(spark, sf):
    return _r9(tn.eval_forced(_scored_train(spark, sf), {"name": "topn"}, topn=50, strong_only=True))


# ---- masks rolled by a day, balanced folds, fold metrics, missing columns and scores ----
@register("recall_flags_rolled")
def q_recall_flags_rolled(spark, sf):
    """The label day's flags from the masks of the day before."""
    inp = fx.load(spark, sf)
    before = recall.pair_masks(inp.actions, inp.items, inp.label_date - dt.timedelta(days=1))
    return recall.flags_of_masks(recall.roll_masks(before, inp.actions, inp.items, inp.label_date))


@register("group_kfold_balanced")
def q_group_kfold_balanced(spark, sf):
    """N8 as the greedy splitter deals: largest user first, to the smallest fold."""
    return sm.group_kfold_balanced(_tf(spark, sf), 5, fx.SEED).select("user_id", "item_id", "label", "fold")


@register("fold_report")
def q_fold_report(spark, sf):
    """AUC, precision, recall and F1 at 5 of every fold."""
    return _r9(mx.fold_report(sm.group_kfold(_scored_train(spark, sf), 3, fx.SEED)))


@register("strong_pairs_missing_columns")
def q_strong_pairs_missing_columns(spark, sf):
    """F16: rule columns that the features lack count as 0."""
    _, pf, _ = _pred(spark, sf)
    return st.strong_pairs(pf.drop("recent_3d_actions", "ui_collect_count"))


@register("cap_submission_unscored")
def q_cap_submission_unscored(spark, sf):
    """Recommendations without a score rank last, as 0."""
    _, pf, res = _pred(spark, sf)
    recs = st.two_stage(res, st.strong_pairs(pf), k=5, m=1)
    return st.cap_submission(recs, st.prefilter(res, min_prob=0.6), fx.SUBMISSION_CAP_UNSCORED)

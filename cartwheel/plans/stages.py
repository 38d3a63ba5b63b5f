"""The three batch stages, chained through Parquet tables.

Each stage reads its inputs, builds one logical plan and writes its outputs;
the written tables are the lineage cuts between stages (as the original's
CSV files are), so a lost executor never forces a recompute from the raw log.

stage 1  candidates  (recall)            -> train_candidates, pred_candidates
stage 2  features    (point-in-time)     -> train_features, pred_features
stage 3  scoring     (sampling, model, strategy, evaluation) -> results, submission
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators import features as feat
from cartwheel.operators import metrics as mx
from cartwheel.operators import recall, sampling, scoring, strategies as st, tuning
from cartwheel.plans.params import Params
from cartwheel.session import scratch_path, scratch_scope
from cartwheel.sources.sinks import read_table, write_embedding, write_submission, write_table


def stage_candidates(spark: SparkSession, actions: DataFrame, items: DataFrame, p: Params,
                     out_dir: str, masks_of_yesterday: str | None = None) -> dict:
    """Stage 1: the pairs' day masks (written once, and kept as
    ``out_dir/pair_masks`` for the next day), then both candidate sets. With the
    masks of the day before only the new day's actions are read."""
    masks_path = f"{out_dir}/pair_masks"
    if masks_of_yesterday:
        masks = recall.roll_masks(read_table(spark, masks_of_yesterday), actions, items, p.label_date)
    else:
        masks = recall.pair_masks(actions, items, p.label_date)
    write_table(masks, masks_path)
    flags = recall.flags_of_masks(read_table(spark, masks_path))
    train = recall.train_candidates(flags, p.max_per_user, p.align_recall, p.pos_filter_in_recall)
    pred = recall.pred_candidates(flags, p.max_per_user)
    if p.enable_hot_backfill and p.max_per_user:
        hot = recall.hot_items(actions, items, p.label_date, p.hot_top)
        pred = recall.backfill_hot(pred, hot, p.max_per_user)
    # In buckets of the pair, as the daily grain: the pair join of stage 2 moves neither.
    write_table(train, f"{out_dir}/train_candidates", bucket_by=feat.PAIR)
    write_table(pred, f"{out_dir}/pred_candidates", bucket_by=feat.PAIR)
    stats = recall.candidate_stats(read_table(spark, f"{out_dir}/train_candidates")).first().asDict()
    return {"train_candidates": f"{out_dir}/train_candidates", "pair_masks": masks_path,
            "pred_candidates": f"{out_dir}/pred_candidates", "stats": stats}


def stage_features(spark: SparkSession, actions: DataFrame, items: DataFrame, p: Params,
                   out_dir: str, grain: DataFrame | None = None) -> dict:
    """Stage 2: features for both candidate sets (train ref = L, predict ref = L + 1),
    from the log or from the streamed day-partial ``grain`` table."""
    for name, is_train in (("train", True), ("pred", False)):
        cands = read_table(spark, f"{out_dir}/{name}_candidates")
        ref = feat.reference_day(p.label_date, is_train)
        f = feat.build_features(actions, items, cands, ref, dedupe_items=p.dedupe_items, grain=grain)
        write_table(f, f"{out_dir}/{name}_features")
    return {"train_features": f"{out_dir}/train_features", "pred_features": f"{out_dir}/pred_features"}


def _feature_list(train: DataFrame, p: Params) -> list[str]:
    return feat.feature_columns(train, exclude=p.exclude_features, drop_time_gaps=p.drop_time_gap_features)


# What a forced strategy takes from the parameters.
FORCED_SETTINGS = {
    "topk_two_stage": {"k": "topk_k", "m": "topk_m"},
    "threshold": {"threshold": "threshold"},
}


def _strategy(p: Params, chosen: dict) -> dict:
    """The strategy that ``force_strategy`` names, else the tuned one."""
    name = st.normalize_strategy(p.force_strategy)
    settings = FORCED_SETTINGS.get(name, {})
    return {"name": name} | {k: getattr(p, source) for k, source in settings.items()} if name else chosen


def _model_report(oof: DataFrame) -> dict:
    """AUC and metrics at 5 of every fold, AUC of all out-of-fold rows, and the ranking metrics."""
    folds = {r["fold"]: r.asDict() for r in mx.fold_report(oof).collect()}             # one row per fold
    return {"fold_auc": {f: r["auc"] for f, r in sorted(folds.items())}, "folds": folds,
            "oof_auc": mx.auc(oof).first()["auc"],
            "metrics": [r.asDict() for r in mx.metric_report(oof).collect()]}


def stage_scoring(spark: SparkSession, actions: DataFrame, p: Params, out_dir: str) -> dict:
    """Stage 3: sampling, k-fold model, pruning, strategy choice, recommendations."""
    train = read_table(spark, f"{out_dir}/train_features")
    pred = read_table(spark, f"{out_dir}/pred_features")
    cols = _feature_list(train, p)
    report: dict = {}
    topn = p.topn if p.topn is not None else p.max_submission          # 0: all

    if p.feature_viz or p.viz_only:
        emb, var = scoring.pca_embedding(train, cols, p.viz_sample_per_class, p.seed)
        write_embedding(emb, f"{out_dir}/feature_viz_pca")            # S8: x, y, label CSV
        report["pca_explained_variance"] = var
        if p.viz_only:
            return report

    fit_rows = train
    if p.downsample_neg:
        if p.bucketed_neg:
            fit_rows = sampling.downsample_chained(train, p.neg_pos_ratio, p.neg_max_gap_days,
                                                   p.recency_bounds, p.seed)
        else:
            fit_rows = sampling.downsample_negatives(train, p.neg_pos_ratio, p.seed, p.neg_max_gap_days)
        sample_path = scratch_path(spark, "fit-rows")
        write_table(fit_rows, sample_path)          # lineage cut before the fold loop
        fit_rows = read_table(spark, sample_path)
    preset = "fast" if p.fast_params else "default"
    class_weight = None if p.downsample_neg else "balanced"

    def run(features):
        return scoring.kfold_train_predict(fit_rows, pred, features, p.n_splits, p.use_group_kfold, p.seed,
                                           preset, p.max_iter, p.early_stopping, class_weight, p.balanced_folds)

    res = run(cols)
    kept, dropped = scoring.drop_zero_importance(res.importance, cols)
    if scoring.should_retrain(kept, dropped, len(cols)):
        res = run(kept)
        cols = kept
    report["features"] = cols
    report["best_iterations"] = [m.best_iteration for m in res.models]
    write_table(res.importance, f"{out_dir}/feature_importance")

    oof_path = f"{out_dir}/oof"
    write_table(res.oof, oof_path)
    oof = read_table(spark, oof_path)
    report["model"] = _model_report(oof)
    sample = oof
    if p.eval_sample_user_frac is not None:
        sample = sampling.user_sample(oof, p.eval_sample_user_frac, p.seed, p.eval_sample_floor)
    strategy = _strategy(p, tuning.choose_strategy(sample))
    report["strategy"] = strategy
    if p.eval_strategy:
        ev = tuning.eval_forced(oof, strategy, p.eval_sample_user_frac, p.min_prob or 0.0, p.max_submission,
                                p.strong_only, p.eval_cart_days_max,
                                topn=topn, seed=p.seed, sample_floor=p.eval_sample_floor)
        report["offline_eval"] = ev.first().asDict()

    results_path = f"{out_dir}/results"
    write_table(st.dedupe_results(res.pred.select("user_id", "item_id", "pred_prob")), results_path)
    results = read_table(spark, results_path)
    results = st.prefilter(results, pred, p.strong_only, p.min_prob)
    recs = st.select_by_strategy(strategy, results, pred,
                                 topn=topn, max_rows=p.cart_max_rows, cart_days_max=p.cart_days_max,
                                 min_rows=p.threshold_min_rows)
    final = st.post_chain(recs, results, actions, p.exclude_day_purchases, p.max_submission)
    write_submission(final, f"{out_dir}/submission")
    report["submission"] = f"{out_dir}/submission"

    if p.val_full:
        scored = scoring.score_mean(res.models, train, res.feature_cols)   # in-sample (Q17)
        report["val_full"] = tuning.full_validation(
            scored, train, strategy, p.strong_only, p.min_prob,
            topn=topn,
            max_rows=p.cart_max_rows, cart_days_max=p.cart_days_max).first().asDict()
    return report


def run_all(spark: SparkSession, actions: DataFrame, items: DataFrame, p: Params, out_dir: str,
            grain: DataFrame | None = None, masks_of_yesterday: str | None = None) -> dict:
    """All three stages in order; each one's scratch tables go when it ends."""
    with scratch_scope(spark):
        r1 = stage_candidates(spark, actions, items, p, out_dir, masks_of_yesterday)
    with scratch_scope(spark):
        stage_features(spark, actions, items, p, out_dir, grain=grain)
    with scratch_scope(spark):
        r3 = stage_scoring(spark, actions, p, out_dir)
    return {"candidates": r1["stats"], **r3}


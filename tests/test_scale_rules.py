"""No hidden caps or size switches; feature plans without hot keys; scratch life cycle."""

import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import features as feat
from cartwheel.operators import metrics as mx
from cartwheel.operators import scoring, tuning
from cartwheel.operators import strategies as st
from cartwheel.plans import fixture as fx
from cartwheel.session import checkpoint_dir, materialize, scratch_path, scratch_scope
from tests.conftest import SF0001


def test_evaluation_covers_all_users(spark):
    n = 25_000
    rows = spark.range(n).select(F.col("id").alias("user_id"), F.lit(1).alias("item_id"), (F.col("id") % 3 == 0).cast("int").alias("label"),
                                 F.when(F.col("id") % 2 == 0, 0.9).otherwise(0.1).alias("pred_prob"), F.lit(1).alias("ui_cart_count"),
                                 F.lit(1).alias("ui_days_since_last_action"))
    r = tuning.eval_forced(rows, {"name": "threshold", "threshold": 0.5}).first()
    assert (r.users, r.pred_cnt) == (n, n // 2)
    r = tuning.eval_forced(rows, {"name": "cart_only"}).first()
    assert (r.users, r.pred_cnt) == (n, n)


def test_zero_and_none_mean_all(spark):
    n = 100_500
    res = spark.range(n).select(F.col("id").alias("user_id"), F.lit(1).cast("long").alias("item_id"), F.lit(0.5).alias("pred_prob"))
    cart = res.select("user_id", "item_id", F.lit(1).alias("ui_cart_count"), F.lit(1).alias("ui_days_since_last_action"))
    for cap in (0, None):
        assert st.select_by_strategy({"name": "topn"}, res, cart, topn=cap).count() == n
        assert st.cart_only(cart, res, max_rows=cap).count() == n
    assert st.cap_submission(res, res, 0).count() == n


@pytest.mark.parametrize("reach, max_rows, days, want", [
    ({1: 5, 2: 9, 3: 12}, 5, 3, 1), ({1: 5, 2: 9, 3: 12}, 6, 3, 2), ({1: 5, 2: 9, 3: 12}, 10, 3, 3),
    ({1: 5, 2: 9, 3: 12}, 100, 3, 3), ({1: 5, 2: 9, 3: 12}, 100, 2, 2), ({1: 5, 2: 9, 3: 12}, 0, 3, 3),
    ({1: 5, 2: 9, 3: 12}, None, 1, 1), ({1: 5, 2: 9, 3: 12}, 100, 0, 1)])
def test_cart_window(reach, max_rows, days, want):
    assert st.cart_window(reach, max_rows, days) == want


def _skewed_log(spark, n=3000):
    """A third of the log is one user's, another third one item's."""
    k = F.col("id")
    user = F.when(k % 3 == 0, 7).otherwise(k % 50).cast("long")
    item = F.when(k % 3 == 1, 11).otherwise(k % 40).cast("long")
    return spark.range(n).select(user.alias("user_id"), item.alias("item_id"), (1 + k % 5).cast("short").alias("behavior_type"),
                                 F.lit(None).cast("string").alias("user_geohash"), (item % 6).alias("item_category"),
                                 F.date_sub(F.lit("2024-01-30").cast("date"), (k % 20).cast("int")).alias("dt"))


def test_skewed_features_equal_plain_sums(spark):
    log = _skewed_log(spark)
    items = spark.range(40).select(F.col("id").alias("item_id"), (F.col("id") % 6).alias("item_category"))
    cands = log.select("user_id", "item_id").distinct()
    out = {(r.user_id, r.item_id): r for r in feat.build_features(log, items, cands, "2024-01-31").collect()}
    rows = log.collect()
    hot = [r for r in rows if r.user_id == 7]
    one = out[7, hot[0].item_id]
    assert one.user_total_actions == len(hot) and one.active_days == len({r.dt for r in hot})
    assert one.unique_categories == len({r.item_category for r in hot})
    of_item = [r for r in rows if r.item_id == 11]
    two = next(r for (u, i), r in out.items() if i == 11)
    assert two.item_total_actions == len(of_item) and two.unique_users == len({r.user_id for r in of_item})


def test_feature_plans_expand_nothing_and_combine_first(spark):
    inp = fx.load(spark, SF0001)
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        cands = inp.train_candidates()
        grain = feat.feature_population(inp.actions, inp.items, cands, inp.train_ref)._jdf.queryExecution().toString()
        # The log is reduced (partial and final) below the joins with the item and user sets.
        physical = grain[grain.index("== Physical Plan =="):]
        assert physical.rindex("SortMergeJoin") < physical.index("HashAggregate") < physical.index("BroadcastHashJoin")
        full = feat.build_features(inp.actions, inp.items, cands, inp.train_ref)._jdf.queryExecution().toString()
        assert "Expand" not in full
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_fixture_is_not_degenerate(spark):
    inp = fx.load(spark, "/root/testdata/sf0.01")
    pf = inp.pred_features()
    assert st.strong_pairs(pf).count() < pf.select("user_id", "item_id").distinct().count()
    assert inp.items.count() > 10 * fx.load(spark, SF0001).items.count() / 2
    assert inp.actions.where("behavior_type = 5").count() > 0


def test_scratch_tables_go_with_their_scope(spark):
    def here():
        path = checkpoint_dir(spark).replace("file:", "")
        return {f for f in os.listdir(path) if re.match("cartwheel-scope", f)}
    assert not here()
    with scratch_scope(spark):
        assert materialize(spark.range(3), "scope-a").count() == 3
        spark.range(2).write.parquet(scratch_path(spark, "scope-b"))
        assert len(here()) == 2
    assert not here()


def test_a_scope_leaves_other_threads_tables_alone(spark):
    import threading
    got = {}

    def other():
        got["kept"] = materialize(spark.range(5), "scope-other")

    with scratch_scope(spark):
        worker = threading.Thread(target=other)
        worker.start()
        worker.join()
        materialize(spark.range(3), "scope-own")
    assert got["kept"].count() == 5


def test_folds_learn_a_planted_signal(spark):
    rows = spark.range(1200).select(F.col("id").alias("user_id"), F.lit(1).cast("long").alias("item_id"),
                                    F.rand(1).alias("x"), F.rand(2).alias("noise")).withColumn(
        "label", (F.col("x") > 0.6).cast("int"))
    rows = materialize(rows, "planted")
    res = scoring.kfold_train_predict(rows, rows, ["x", "noise"], n_splits=3, preset="default", max_iter=10)
    assert mx.auc(res.oof).first()["auc"] > 0.98
    imp = {r.feature: r.importance for r in res.importance.collect()}
    assert imp["x"] > 10 * imp["noise"]
    gains = [t.gain[t.feature == 0].sum() for m in res.models for t in m.used()]
    assert imp["x"] == pytest.approx(sum(gains))
    # The mean of the fold models, by hand.
    one = rows.orderBy("user_id").limit(5)
    want = [0.0] * 5
    for m in res.models:
        x = np.array([[r.x, r.noise] for r in one.orderBy("user_id").collect()])
        want = [w + p / len(res.models) for w, p in zip(want, 1 / (1 + np.exp(-m.margin(x))))]
    got = [r.pred_prob for r in scoring.score_mean(res.models, one, ["x", "noise"]).orderBy("user_id").collect()]
    assert got == pytest.approx(want)


def test_a_fold_without_rows_is_an_error(spark):
    rows = spark.createDataFrame([(1, 1, 0.5, 1), (1, 2, 0.1, 0)], "user_id long, item_id long, x double, label int")
    with pytest.raises(ValueError, match="fold"):
        scoring.kfold_train_predict(rows, None, ["x"], n_splits=2, max_iter=1, early_stopping=0)


def test_folds_are_not_shuffled_by_label(spark):
    from cartwheel.operators import sampling
    rows = spark.range(200).select(F.col("id").alias("user_id"), F.lit(1).alias("item_id"), (F.col("id") % 2).alias("label"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sampling.stratified_kfold(rows, 5)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

"""Hand-worked cases of FIXTURES.md section 2."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import features as feat
from cartwheel.operators import metrics as mx
from cartwheel.operators import recall, sampling
from cartwheel.operators import strategies as st
from tests.handcase import L, frames


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def hand(spark):
    actions, items = frames(spark)
    flags = recall.pair_flags(actions, items, L)
    return actions, items, flags


def test_train_candidates_aligned(hand):
    _, _, flags = hand
    got = rows(recall.train_candidates(flags), "user_id", "item_id", "label")
    assert got == [(1, 10, 1), (1, 11, 0), (2, 10, 0)]


def test_train_candidates_unaligned(hand):
    _, _, flags = hand
    got = rows(recall.train_candidates(flags, align_recall=False), "user_id", "item_id", "label")
    assert got == [(1, 10, 1), (1, 11, 0), (2, 10, 0), (2, 12, 1)]


def test_unaligned_features_fan_out(hand, spark):
    actions, items, flags = hand
    cands = recall.train_candidates(flags, align_recall=False)
    f = feat.build_features(actions, items, cands, L)
    # item 12 is listed twice in P: its candidate row is doubled (Q3)
    assert f.where("item_id = 12").count() == 2
    assert feat.build_features(actions, items, cands, L, dedupe_items=True).where("item_id = 12").count() == 1


def test_pred_candidates(hand):
    _, _, flags = hand
    assert rows(recall.pred_candidates(flags), "user_id", "item_id") == [(1, 10), (2, 12)]


@pytest.fixture(scope="module")
def train_feats(hand):
    actions, items, flags = hand
    return {(r.user_id, r.item_id): r for r in
            feat.build_features(actions, items, recall.train_candidates(flags), L).collect()}


def test_user_features(train_feats):
    u1 = train_feats[(1, 10)]
    assert (u1.user_total_actions, u1.behavior_1_count, u1.behavior_2_count, u1.behavior_3_count,
            u1.behavior_4_count) == (5, 3, 1, 1, 0)
    assert (u1.active_days, u1.avg_actions_per_day, u1.recent_7d_actions, u1.recent_3d_actions,
            u1.days_since_last_action, u1.unique_categories) == (4, 1.25, 2, 2, 1, 2)
    u2 = train_feats[(2, 10)]
    assert (u2.user_total_actions, u2.behavior_1_count, u2.behavior_2_count, u2.behavior_3_count,
            u2.behavior_4_count, u2.active_days) == (1, 1, 0, 0, 0, 1)
    assert (u2.recent_7d_actions, u2.recent_3d_actions, u2.days_since_last_action, u2.unique_categories) == (1, 0, 7, 1)


def test_item_features(train_feats):
    i10 = train_feats[(1, 10)]
    assert (i10.item_total_actions, i10.views, i10.total_purchases, i10.unique_users, i10.avg_actions_per_user,
            i10.recent_7d_views, i10.recent_3d_views, i10.days_since_last_view) == (4, 3, 0, 2, 2.0, 3, 2, 1)
    i11 = train_feats[(1, 11)]
    # gap 14 although never viewed (Q2)
    assert (i11.item_total_actions, i11.views, i11.unique_users, i11.recent_7d_views, i11.recent_3d_views,
            i11.days_since_last_view) == (1, 0, 1, 0, 0, 14)


def test_pair_features(train_feats):
    p = train_feats[(1, 10)]
    assert (p.ui_total_actions, p.ui_view_count, p.ui_collect_count, p.ui_days_since_last_action,
            p.ui_action_span_days, p.ui_avg_actions_per_day) == (3, 2, 1, 1, 15, 0.2)
    p = train_feats[(1, 11)]
    assert (p.ui_total_actions, p.ui_cart_count, p.ui_days_since_last_action, p.ui_action_span_days) == (1, 1, 14, 1)
    p = train_feats[(2, 10)]
    assert (p.ui_total_actions, p.ui_view_count, p.ui_days_since_last_action, p.ui_action_span_days) == (1, 1, 7, 1)


def test_user_category_features(train_feats):
    assert (train_feats[(1, 10)].user_category_actions, train_feats[(1, 10)].user_category_items) == (4, 2)
    assert (train_feats[(2, 10)].user_category_actions, train_feats[(2, 10)].user_category_items) == (1, 1)


def test_strong_pairs(hand, spark):
    actions, items, flags = hand
    f = feat.build_features(actions, items, recall.train_candidates(flags), L)
    assert rows(st.strong_pairs(f), "user_id", "item_id") == [(1, 10), (1, 11)]


def test_no_future_leak(hand, spark):
    """Features must not change when rows on or after ref are added."""
    actions, items, flags = hand
    cands = recall.train_candidates(flags)
    extra = spark.createDataFrame([(1, 10, 4, None, 7, dt.date(2014, 12, 18)),
                                   (2, 10, 3, None, 7, dt.date(2014, 12, 20))], actions.schema)
    a = feat.build_features(actions, items, cands, L).collect()
    b = feat.build_features(actions.unionByName(extra), items, cands, L).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_two_stage_cases(spark):
    # user 1: 5 strong, 0 weak; user 2: 2 strong, 4 weak
    res = spark.createDataFrame(
        [(1, i, 0.9 - i / 100) for i in range(5)] + [(2, i, 0.5 + i / 100) for i in range(6)],
        "user_id bigint, item_id bigint, pred_prob double")
    strong = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 0), (2, 1)], "user_id bigint, item_id bigint")
    out = st.two_stage(res, strong, k=3, m=1)
    by_user = {}
    for r in out.collect():
        by_user.setdefault(r.user_id, []).append(r.item_id)
    assert len(by_user[1]) == 1 and by_user[1] == [0]
    # best strong of user 2 is item 1 (0.51), best weak are items 5, 4
    assert sorted(by_user[2]) == [1, 4, 5]


def test_metrics_case(spark):
    df = spark.createDataFrame([(1, 1, 0, 0.9), (1, 2, 1, 0.8), (1, 3, 1, 0.7), (2, 4, 0, 0.6)],
                               "user_id bigint, item_id bigint, label int, pred_prob double")
    assert mx.auc(df).first()["auc"] == pytest.approx(0.5)
    m = {r.k: r for r in mx.ranking_metrics(df, (3,)).collect()}[3]
    assert m.precision == pytest.approx(1 / 3)
    assert m.recall == pytest.approx(0.5)
    assert m.hit_ratio == pytest.approx(0.5)
    assert m.f1 == pytest.approx(0.4)
    assert m.ndcg == pytest.approx(0.346713, abs=1e-6)


def test_bucketed_sampling_case(spark):
    pos = [(1, i, 1, g) for i, g in enumerate([1, 1, 5])]
    neg = [(2, 10 + i, 0, g) for i, g in enumerate([1, 2, 3, 5, 6, 8])]
    df = spark.createDataFrame(pos + neg, "user_id bigint, item_id bigint, label int, ui_days_since_last_action int")
    out = sampling.downsample_negatives_bucketed(df, neg_pos_ratio=1, bounds=[1, 3, 7])
    got = out.collect()
    assert len(got) == 5
    neg_gaps = sorted(r.ui_days_since_last_action for r in got if r.label == 0)
    assert neg_gaps[0] == 1 and neg_gaps[1] in (5, 6)


def test_half_even(spark):
    got = spark.range(1).select(*[F.bround(F.lit(v), 0).alias(f"c{i}") for i, v in enumerate([0.5, 1.5, 2.5])]).first()
    assert list(got) == [0.0, 2.0, 2.0]


def test_empty_class(spark):
    df = spark.createDataFrame([(1, i, 0, 0.5) for i in range(5)],
                               "user_id bigint, item_id bigint, label int, pred_prob double")
    assert sampling.downsample_negatives(df, 1).count() == 5
    assert sampling.downsample_negatives_bucketed(
        df.withColumn("ui_days_since_last_action", F.lit(1)), 1).count() == 5
    f1 = mx.f1_row(mx.threshold_counts(df, 0.1)).first()
    assert (f1.f1, f1.precision, f1.recall) == (0.0, 0.0, 0.0)
    assert mx.auc(df).first()["auc"] is None


def test_gap_filter_empties_negatives_returns_input(spark):
    df = spark.createDataFrame([(1, 1, 1, 1), (1, 2, 0, 9)],
                               "user_id bigint, item_id bigint, label int, ui_days_since_last_action int")
    # Q7: the gap filter removes every negative -> the input comes back whole
    assert sampling.downsample_negatives(df, 1, neg_max_gap_days=3).count() == 2


def test_limits_that_mean_all(spark):
    res = spark.createDataFrame([(1, i, i / 10) for i in range(7)], "user_id bigint, item_id bigint, pred_prob double")
    assert st.global_topn(res, 0).count() == 7
    assert st.cap_submission(res, res, 0).count() == 7
    actions, _ = frames(spark)
    assert st.exclude_day_buys(res, actions, "20150101").count() == 7


def test_cart_ladder(spark):
    feats = spark.createDataFrame(
        [(1, 1, 1, 1), (1, 2, 1, 2), (1, 3, 1, 3), (1, 4, 0, 1), (1, 5, 1, 5)],
        "user_id bigint, item_id bigint, ui_cart_count bigint, ui_days_since_last_action int")
    res = feats.select("user_id", "item_id", (F.col("item_id") / 10).alias("pred_prob"))
    assert rows(st.cart_only(feats, res, max_rows=1, cart_days_max=3), "item_id") == [(1,)]
    assert rows(st.cart_only(feats, res, max_rows=2, cart_days_max=3), "item_id") == [(1,), (2,)]
    assert rows(st.cart_only(feats, res, max_rows=5, cart_days_max=3), "item_id") == [(1,), (2,), (3,)]
    assert rows(st.cart_only(feats, res, max_rows=5, cart_days_max=1), "item_id") == [(1,)]
    assert rows(st.cart_only(feats, res, max_rows=0, cart_days_max=2), "item_id") == [(1,), (2,)]


def test_two_stage_dedupes_pairs(spark):
    # A pair listed twice counts once, with its best score
    res = spark.createDataFrame([(1, 1, 0.2), (1, 1, 0.9), (1, 2, 0.5), (1, 3, 0.4)],
                                "user_id bigint, item_id bigint, pred_prob double")
    strong = spark.createDataFrame([], "user_id bigint, item_id bigint")
    assert rows(st.two_stage(res, strong, k=2, m=1), "item_id") == [(1,), (2,)]

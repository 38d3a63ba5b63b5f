"""Invariants on the bridged sf0.01 data, and results independent of the
number of shuffle partitions."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cartwheel.operators import sampling
from cartwheel.plans import fixture as fx
from tests.conftest import SF001
from tests.oracle_compare import value_hash

Q = E.queries()


def test_cap_per_user(spark):
    df = Q["candidates_capped"](spark, SF001)
    assert df.groupBy("user_id").count().agg(F.max("count")).first()[0] <= fx.CAP_BINDING
    df = Q["pred_candidates_backfilled"](spark, SF001)
    assert df.groupBy("user_id").count().agg(F.max("count")).first()[0] <= fx.CAP_BACKFILL
    assert df.count() == df.distinct().count()


def test_labels_within_recall(spark):
    train = Q["train_candidates"](spark, SF001).where("label = 1")
    recall = Q["recall_union"](spark, SF001)
    assert train.join(recall, ["user_id", "item_id"], "left_anti").count() == 0


def test_sample_quota(spark):
    tf = fx.load(spark, SF001).train_features()
    n_pos = tf.where("label = 1").count()
    out = sampling.downsample_negatives(tf, neg_pos_ratio=3)
    assert out.where("label = 1").count() == n_pos
    assert out.where("label = 0").count() == min(tf.where("label = 0").count(), 3 * n_pos)
    assert out.count() == out.distinct().count()


def test_submission_bounds(spark):
    sub = Q["submission"](spark, SF001)
    n = sub.count()
    assert n <= 100 and n == sub.distinct().count()


def test_one_fold_per_user(spark):
    folds = Q["group_kfold"](spark, SF001)
    assert folds.groupBy("user_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    strat = Q["stratified_kfold"](spark, SF001)
    sizes = {(r.label, r.fold): r["count"] for r in strat.groupBy("label", "fold").count().collect()}
    for lab in (0, 1):
        per = [sizes.get((lab, f), 0) for f in range(5)]
        assert max(per) - min(per) <= 1


PARTITION_QUERIES = ["train_candidates", "pred_candidates", "global_topn", "two_stage", "neg_sample_bucketed",
                     "stratified_kfold", "metric_report", "cart_only", "score_quantiles"]


def test_partition_count_invariance(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    hashes = {}
    try:
        for parts in ("1", "4", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for name in PARTITION_QUERIES:
                df = Q[name](spark, SF001)
                hashes.setdefault(name, set()).add(value_hash(df.columns, [tuple(r) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {k: len(v) for k, v in hashes.items()} == {k: 1 for k in PARTITION_QUERIES}

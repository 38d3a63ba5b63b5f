"""Writers in the original file formats and the INI parameter reader."""

import os

from cartwheel.plans import fixture as fx
from cartwheel.plans.params import Params
from cartwheel.sources.sinks import read_csv, write_csv, write_embedding, write_submission
from tests.conftest import SF0001


def test_csv_round_trip_with_original_names(spark, tmpdir_path):
    tf = fx.load(spark, SF0001).train_features()
    path = os.path.join(tmpdir_path, "train_features_csv")
    write_csv(tf, path)
    raw = spark.read.option("header", "true").csv(path)
    assert "total_actions_x" in raw.columns and "total_actions_y" in raw.columns
    back = read_csv(spark, path, schema=tf.schema)
    assert sorted(back.columns) == sorted(tf.columns)
    assert back.count() == tf.count()


def test_submission_format(spark, tmpdir_path):
    recs = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "user_id bigint, item_id bigint")
    path = os.path.join(tmpdir_path, "submission")
    write_submission(recs, path)
    lines = []
    for name in os.listdir(path):
        if name.startswith("part-"):
            with open(os.path.join(path, name)) as fh:
                lines += fh.read().splitlines()
    assert sorted(lines) == ["1\t2", "3\t4"]


def test_embedding_writer(spark, tmpdir_path):
    emb = spark.createDataFrame([(0.1, 0.2, 1)], "x double, y double, label int")
    path = os.path.join(tmpdir_path, "emb")
    write_embedding(emb, path)
    assert spark.read.option("header", "true").csv(path).columns == ["x", "y", "label"]


def test_params_from_ini(tmpdir_path):
    ini = os.path.join(tmpdir_path, "config.ini")
    with open(ini, "w") as fh:
        fh.write("[training]\nneg_pos_ratio = 1\nneg_max_gap_days = 3\nn_splits = 5\nlabel_date = 20141218\n"
                 "[strategy]\nforce_strategy = cart_only\nstrong_only = 1\nmin_prob = 0.09\n"
                 "max_submission = 45000\nexclude_day_purchases = 0\ncart_days_max = 1\n")
    p = Params.from_ini(ini)
    assert p.neg_pos_ratio == 1 and p.neg_max_gap_days == 3 and p.n_splits == 5
    assert p.force_strategy == "cart_only" and p.strong_only is True and p.min_prob == 0.09
    assert p.max_submission == 45000 and p.cart_max_rows == 45000 and p.exclude_day_purchases is None
    assert p.cart_days_max == 1 and p.label_date.isoformat() == "2014-12-18"


FULL_INI = """[training]
downsample_neg = 1
neg_pos_ratio = 1
neg_max_gap_days = 3
use_group_kfold = 1
fast_params = 0
n_splits = 5
early_stopping = 200
log_eval_every = 1
label_date = 20141218
exclude_features = ui_cart_count, ui_view_count
recency_bounds = 1,3,7
[strategy]
force_strategy = cart_only
strong_only = 1
min_prob = 0.09
topn = 0
max_submission = 0
exclude_day_purchases = 20141218
topk_k = 3
topk_m = 1
cart_days_max = 1
[eval]
eval_strategy = 1
eval_sample_user_frac = 0.02
eval_sample_floor = 20000
val_full = 1
val_batch = 1000000
[recall]
align_recall = 0
pos_filter_in_recall = 1
[viz]
feature_viz = 0
viz_only = 1
viz_sample_per_class = 10000
viz_methods = pca,tsne
"""


def test_every_key_of_the_ini(tmpdir_path):
    ini = os.path.join(tmpdir_path, "full.ini")
    with open(ini, "w") as fh:
        fh.write(FULL_INI)
    p = Params.from_ini(ini)
    assert p.early_stopping == 200 and p.use_group_kfold is True and p.fast_params is False
    assert p.exclude_features == ("ui_cart_count", "ui_view_count") and p.recency_bounds == (1, 3, 7)
    assert p.topn == 0 and p.max_submission == 0 and p.cart_max_rows == 0
    assert p.exclude_day_purchases == "20141218" and p.eval_sample_user_frac == 0.02 and p.eval_sample_floor == 20000
    assert p.align_recall is False and p.viz_only is True and p.val_full is True and p.eval_cart_days_max == 1
    assert set(p.extra) == {"log_eval_every", "val_batch", "viz_methods"}


def test_set_text_of_the_command_line():
    p = Params()
    p.set_text("exclude_features", "ui_cart_count")
    p.set_text("min_prob", "")
    p.set_text("max_per_user", "200")
    assert p.exclude_features == ("ui_cart_count",) and p.min_prob is None and p.max_per_user == 200

"""Day masks, rolling recall, the filter before the shuffle, bucketed stage tables."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from cartwheel.functions import prefilter
from cartwheel.operators import features as feat
from cartwheel.operators import recall
from cartwheel.session import _TABLES, materialize, read_bucketed, remove, scratch_path, write_bucketed
from cartwheel.sources.sinks import read_table, write_table

L = dt.date(2024, 1, 30)


def log(spark, n=3000, days=40, hot=True, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        user = 1 if hot and rng.random() < 0.35 else rng.randrange(2, 60)
        item = rng.randrange(200)
        rows.append((user, item, rng.choice([1, 1, 1, 2, 3, 4]), item % 7, L - dt.timedelta(days=rng.randrange(-3, days))))
    return spark.createDataFrame(rows, "user_id long, item_id long, behavior_type short, item_category long, dt date")


def items(spark, step=2):
    return spark.createDataFrame([(i, i % 7) for i in range(0, 200, step)], "item_id long, item_category long")


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_flags_rolled_day_by_day_equal_a_rebuild(spark):
    actions, p = log(spark).cache(), items(spark).cache()
    day = L - dt.timedelta(days=6)
    masks = recall.pair_masks(actions, p, day)
    for k in range(1, 8):
        day += dt.timedelta(days=1)
        masks = materialize(recall.roll_masks(masks, actions, p, day), "masks")
        want = recall.pair_flags(actions, p, day)
        got = recall.flags_of_masks(masks)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert rows_of(got) == rows_of(want), day
        assert rows_of(masks) == rows_of(recall.pair_masks(actions, p, day))


def test_rolling_reads_the_new_day_alone(spark, tmpdir_path):
    log(spark).write.partitionBy("dt").parquet(f"{tmpdir_path}/log")
    actions, p = spark.read.parquet(f"{tmpdir_path}/log"), items(spark)
    masks = materialize(recall.pair_masks(actions, p, L - dt.timedelta(days=1)), "masks")
    plan = recall.roll_masks(masks, actions, p, L)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "behavior_type" in line)
    assert f">= {L}" in scan and f"<= {L}" in scan


def test_empty_log_has_no_masks(spark):
    none = log(spark, n=1).limit(0)
    masks = recall.pair_masks(none, items(spark), L)
    assert recall.flags_of_masks(recall.roll_masks(masks, none, items(spark), L)).count() == 0


@pytest.mark.parametrize("days", [10, 63, 64, 65, 200])
def test_active_days_by_masks(spark, days):
    rng = random.Random(days)
    rows = [(u, i % 5, i % 3, L - dt.timedelta(days=1 + (days - 1 if u == 0 and i == 0 else rng.randrange(days))), 1, 1, 0, 0, 0)
            for u in range(8) for i in range(40)]
    daily = spark.createDataFrame(rows, "user_id long, item_id long, item_category long, dt date, n long, n1 long, n2 long, n3 long, n4 long")
    got = {r.user_id: r.active_days for r in feat.user_aggregates(daily, L).collect()}
    assert got == {u: len({r[3] for r in rows if r[0] == u}) for u in range(8)}


def test_history_beyond_the_masks(spark, monkeypatch):
    daily = feat.daily_grain(log(spark, n=500).where(F.col("dt") < F.lit(str(L)).cast("date")))
    want = rows_of(feat.user_aggregates(daily, L))
    monkeypatch.setattr(feat, "MAX_MASKS", 0)
    assert rows_of(feat.user_aggregates(daily, L)) == want


def test_users_are_aggregated_without_a_shuffle_by_day(spark):
    daily = materialize(feat.daily_grain(log(spark, n=500)), "grain")
    plan = feat.user_aggregates(daily, L)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(user_id#\d+L?, dt", plan)


def test_rows_that_cannot_match_go_before_the_shuffle(spark):
    actions, p = log(spark).cache(), items(spark, step=40)
    few = spark.createDataFrame([(u, 0) for u in (3, 4, 5)], "user_id long, item_id long")
    left = prefilter.maybe_in(prefilter.maybe_in(actions, p, "item_id"), few, "user_id")
    exact = actions.join(p, "item_id", "left_semi").join(few, "user_id", "left_semi")
    assert exact.count() <= left.count() < actions.count() / 20
    assert left.columns == actions.columns
    pop = feat.feature_population(actions, p, few, L)
    plan = pop._jdf.queryExecution().executedPlan().toString().split("\n")
    grain = max(k for k, line in enumerate(plan) if "HashAggregate" in line and "behavior_type" in line or "partial_count" in line)
    assert sum("LeftSemi" in line for line in plan[grain:]) == 2                  # below the map-side aggregate
    want = feat.grain_population(feat.daily_grain(actions.where(F.col("dt") < F.lit(str(L)).cast("date"))), p, few, L)
    assert rows_of(pop) == rows_of(want)


def test_many_keys_switch_the_filter_off(spark, monkeypatch):
    monkeypatch.setattr(prefilter, "MOST_BUCKETS", 10)
    actions = log(spark, n=200)
    assert prefilter.maybe_in(actions, actions, "user_id") is actions


def test_no_exchange_under_the_pair_join(spark):
    """Candidates and grain in buckets of the pair meet without a shuffle, and a
    user with a third of the rows lies in many buckets."""
    actions, p = log(spark), items(spark, step=1)
    cands = write_bucketed(actions.select("user_id", "item_id").distinct(), scratch_path(spark, "cands"), feat.PAIR)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = feat.build_features(actions, p, cands, L)
        plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    join = next(k for k, line in enumerate(plan) if "SortMergeJoin [user_id#" in line and ", item_id#" in line.split("]")[0])
    depth = len(plan[join]) - len(plan[join].lstrip(" :+-*"))
    below = []
    for line in plan[join + 1:]:
        if line.strip() and len(line) - len(line.lstrip(" :+-*")) <= depth:
            break
        below.append(line)
    assert sum("FileScan" in line for line in below) == 2 and not any("Exchange" in line for line in below)
    sizes = [r["n"] for r in cands.where("user_id = 1").groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < sum(sizes) / 3
    plain = feat.build_features(actions, p, materialize(cands, "plain"), L, materialize_daily=False)
    assert rows_of(out) == rows_of(plain)


def test_bucketed_stage_tables_read_as_plain_files_too(spark, tmpdir_path):
    df = log(spark, n=300).select("user_id", "item_id").distinct()
    path = f"{tmpdir_path}/stage"
    write_table(df, path, bucket_by=feat.PAIR)
    assert rows_of(read_table(spark, path)) == rows_of(spark.read.parquet(path)) == rows_of(df)
    count = read_table(spark, path).groupBy("user_id", "item_id").count()
    assert "Exchange" not in count._jdf.queryExecution().executedPlan().toString()
    again = read_bucketed(spark, path, df.schema, feat.PAIR, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert rows_of(again) == rows_of(df)
    assert "Exchange" not in again.groupBy("user_id", "item_id").count()._jdf.queryExecution().executedPlan().toString()
    write_table(df.limit(5), path, bucket_by=feat.PAIR)                          # a rerun overwrites
    assert read_table(spark, path).count() == 5
    name = _TABLES[path]
    remove(spark, path)
    assert path not in _TABLES and not spark.catalog.tableExists(name)


def test_a_hot_list_longer_than_the_cap(spark):
    """Only its first items can be needed, and none is missed."""
    pred = spark.createDataFrame([(u, i) for u in range(6) for i in range(u)], "user_id long, item_id long")
    hot = spark.createDataFrame([(i, 100 - i, i + 1) for i in range(50)], "item_id long, cnt long, hot_rank int")
    got = {}
    for r in recall.backfill_hot(pred, hot, 8).collect():
        got.setdefault(r.user_id, set()).add(r.item_id)
    assert got == {u: set(range(8)) for u in range(1, 6)}

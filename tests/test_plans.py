"""Plan shape of every registered query: no cartesian or nested-loop joins,
per-user windows with a partial group limit, pruned and pushed-down scans."""

import re

import pytest

from cartwheel.operators import recall
from cartwheel.plans import fixture as fx
from cartwheel.plans.catalog import QUERIES as Q
from tests.conftest import SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(Q[name](spark, SF0001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["train_candidates", "pred_candidates", "two_stage", "topk_per_user",
                                  "metric_report", "grid_two_stage"])
def test_per_user_windows_are_limited_before_the_shuffle(spark, name):
    df = Q[name](spark, SF0001)
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_recall_scan_is_pruned_and_pushed(spark, tmpdir_path):
    inp = fx.load(spark, SF0001)
    inp.actions.write.partitionBy("dt").parquet(f"{tmpdir_path}/actions")
    log = spark.read.parquet(f"{tmpdir_path}/actions")
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(recall.train_candidates(recall.pair_flags(log, inp.items, inp.label_date)))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line and "actions" in line][0]
    assert "ReadSchema: struct<user_id:bigint,item_id:bigint,behavior_type:smallint>" in scan
    assert "PartitionFilters: [isnotnull(dt" in scan and ">= 2024-01-16" in scan


def test_candidate_rows_shuffle_at_most_three_times(spark):
    """With no broadcast (as for large tables), the candidate rows pass at most
    three exchanges on their way to the feature table."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = _plan(Q["train_features"](spark, SF0001)).split("\n")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)

    def depth(line):
        return len(line) - len(line.lstrip(" :+-*"))

    # the candidate table is the only scan that reads the label column
    scan = next(i for i, line in enumerate(plan)
                if re.search(r"FileScan parquet \[user_id#\d+L,item_id#\d+L,label#\d+\]", line))
    exchanges, d = 0, depth(plan[scan])
    for line in reversed(plan[:scan]):          # walk up to the root through the ancestors
        if line.strip() and depth(line) < d:
            d = depth(line)
            exchanges += "Exchange hashpartitioning" in line
    assert exchanges <= 3

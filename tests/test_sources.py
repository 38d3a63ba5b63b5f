"""Daily shard reader, landing with partition pruning, streaming ingest."""

import os

from pyspark.sql import functions as F

from cartwheel.sources import bridge
from cartwheel.sources.daily_logs import actions_before, land_daily_shards, read_actions, read_daily_shards
from cartwheel.streaming.ingest import land_daily_stream
from tests.conftest import SF0001


def _write_shards(spark, folder):
    """Write the bridged sf0.001 log as data_YYYYMMDD.txt shards plus decoys."""
    pdf = bridge.actions_from_events(spark, SF0001).toPandas()
    os.makedirs(folder, exist_ok=True)
    for d, g in pdf.groupby("dt"):
        name = f"data_{d.strftime('%Y%m%d')}.txt"
        g[["user_id", "item_id", "behavior_type", "user_geohash", "item_category"]].to_csv(
            os.path.join(folder, name), sep="\t", header=False, index=False)
    with open(os.path.join(folder, "notes.txt"), "w") as fh:
        fh.write("not a shard\n")
    with open(os.path.join(folder, "data_20241399.txt"), "w") as fh:   # not a date: skipped
        fh.write("1\t1\t1\t\t1\n")
    return pdf


def test_read_and_land(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "daily")
    pdf = _write_shards(spark, src)
    df = read_daily_shards(spark, src)
    assert df.count() == len(pdf)
    got = sorted(tuple(r) for r in df.select("user_id", "item_id", "behavior_type", "item_category", "dt").collect())
    want = sorted(zip(pdf.user_id, pdf.item_id, pdf.behavior_type, pdf.item_category, pdf.dt))
    assert got == want
    out = os.path.join(tmpdir_path, "landed")
    land_daily_shards(spark, src, out)
    landed = read_actions(spark, out)
    assert landed.count() == len(pdf)
    plan = actions_before(landed, "2024-01-10")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-10" in plan


def test_streaming_ingest(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "daily")
    pdf = _write_shards(spark, src)
    out = os.path.join(tmpdir_path, "stream_out")
    q = land_daily_stream(spark, src, out, os.path.join(tmpdir_path, "ckpt"), max_files_per_trigger=5)
    q.awaitTermination(300)
    landed = spark.read.parquet(out)
    assert landed.count() == len(pdf)
    assert landed.select(F.countDistinct("dt")).first()[0] == pdf.dt.nunique()
    # a second run lands nothing new (the checkpoint remembers the files)
    q2 = land_daily_stream(spark, src, out, os.path.join(tmpdir_path, "ckpt"), max_files_per_trigger=5)
    q2.awaitTermination(300)
    assert spark.read.parquet(out).count() == len(pdf)


def test_command_line_end_to_end(spark, tmpdir_path):
    """Shards and an item TSV written from the bridged tables, landed, then the
    three stages through the command line with an INI of the original layout."""
    from cartwheel.__main__ import main
    src = os.path.join(tmpdir_path, "daily")
    _write_shards(spark, src)
    items = bridge.target_items_from_part(spark, SF0001).toPandas()
    items_path = os.path.join(tmpdir_path, "items.tsv")
    items.assign(geo="")[["item_id", "geo", "item_category"]].to_csv(items_path, sep="\t", header=False, index=False)
    ini = os.path.join(tmpdir_path, "config.ini")
    with open(ini, "w") as fh:
        fh.write("[training]\nneg_pos_ratio = 5\nn_splits = 2\nlabel_date = 20240130\n"
                 "[strategy]\nforce_strategy = topk\ntopk_k = 3\ntopk_m = 1\nmax_submission = 40\n"
                 "exclude_day_purchases = 20240130\n[eval]\nval_full = 0\n")
    table = os.path.join(tmpdir_path, "actions")
    out = os.path.join(tmpdir_path, "out")
    assert main(["land", "--daily", src, "--actions", table]) == 0
    assert main(["all", "--actions", table, "--items", items_path, "--out", out, "--config", ini,
                 "--set", "max_iter=3", "--set", "fast_params=0"]) == 0
    sub = spark.read.option("sep", "\t").csv(os.path.join(out, "submission"))
    assert 0 < sub.count() <= 40
    cands = spark.read.parquet(os.path.join(out, "train_candidates"))
    assert cands.count() == 165        # FIXTURES.md: 165 aligned train candidates at sf0.001
    # the same features from the streamed day partials
    grain = os.path.join(tmpdir_path, "grain")
    out2 = os.path.join(tmpdir_path, "out2")
    assert main(["grain", "--daily", src, "--actions", table, "--grain", grain]) == 0
    assert main(["candidates", "--actions", table, "--items", items_path, "--out", out2, "--config", ini]) == 0
    assert main(["features", "--actions", table, "--items", items_path, "--out", out2, "--config", ini,
                 "--grain", grain]) == 0
    for name in ("train_features", "pred_features"):
        a = spark.read.parquet(os.path.join(out, name)).collect()
        b = spark.read.parquet(os.path.join(out2, name)).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_daily_grain_stream_gives_same_features(spark, tmpdir_path):
    """Day partials landed by the stream (several micro-batches) give the same
    features as the raw log."""
    from cartwheel.operators import features as feat
    from cartwheel.plans import fixture as fx
    from cartwheel.streaming.daily_grain import land_daily_grain_stream, read_daily_grain
    src = os.path.join(tmpdir_path, "daily")
    _write_shards(spark, src)
    out = os.path.join(tmpdir_path, "grain")
    q = land_daily_grain_stream(spark, src, out, os.path.join(tmpdir_path, "gckpt"), max_files_per_trigger=4)
    q.awaitTermination(600)
    grain = read_daily_grain(spark, out)
    inp = fx.load(spark, SF0001)
    for cands, ref in ((inp.train_candidates(), inp.train_ref), (inp.pred_candidates(), inp.pred_ref)):
        a = feat.build_features(inp.actions, inp.items, cands, ref).collect()
        b = feat.build_features(None, inp.items, cands, ref, grain=grain).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_grain_stream_rerun_is_incremental(spark, tmpdir_path):
    """A second run with a new shard lands only that shard (default checkpoint
    kept beside the table), and the grain still covers every row once."""
    import shutil
    from cartwheel.streaming.daily_grain import land_daily_grain_stream, read_daily_grain
    src = os.path.join(tmpdir_path, "daily")
    pdf = _write_shards(spark, src)
    names = sorted(n for n in os.listdir(src) if n.startswith("data_2024") and n != "data_20241399.txt")
    hold = os.path.join(tmpdir_path, "held")
    os.makedirs(hold)
    shutil.move(os.path.join(src, names[-1]), os.path.join(hold, names[-1]))
    out = os.path.join(tmpdir_path, "grain")
    land_daily_grain_stream(spark, src, out, max_files_per_trigger=10).awaitTermination(600)
    first = read_daily_grain(spark, out).agg({"n": "sum"}).first()[0]
    shutil.move(os.path.join(hold, names[-1]), os.path.join(src, names[-1]))
    land_daily_grain_stream(spark, src, out, max_files_per_trigger=10).awaitTermination(600)
    total = read_daily_grain(spark, out).agg({"n": "sum"}).first()[0]
    assert first < total == len(pdf)

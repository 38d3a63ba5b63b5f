"""Newton boosting on Spark ML trees, against loops in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import boosting as bo
from cartwheel.operators import scoring

COLS = ["a", "b", "c"]


def table(spark, n=900, seed=1, noise=0.3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + x[:, 1] ** 2 + noise * rng.normal(size=n) > 0.8).astype(int)
    rows = [(k, int(k % 60), *map(float, x[k]), int(y[k])) for k in range(n)]
    return spark.createDataFrame(rows, "item_id long, user_id long, a double, b double, c double, label int").repartition(5).cache()


def matrix(df):
    rows = df.orderBy("item_id").collect()
    return np.array([[r[c] for c in COLS] for r in rows]), np.array([r.label for r in rows], float)


PLAIN = bo.BoostParams(max_iter=7, max_depth=3, learning_rate=0.3, min_rows_leaf=5, reg_lambda=2.5, chunk=3)


def test_leaf_values_and_gains_equal_a_loop(spark):
    df = table(spark)
    model = bo.fit(df, COLS, PLAIN)
    x, y = matrix(df)
    margin = np.full(len(x), np.log(y.mean() / (1 - y.mean())))
    assert model.start == pytest.approx(margin[0]) and len(model.trees) == model.best_iteration == 7
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        leaf = tree.leaves(x)
        for k in np.flatnonzero(tree.feature < 0):
            mine = leaf == k
            assert tree.rows[k] == mine.sum() >= 5
            assert tree.grad[k] == pytest.approx(g[mine].sum()) and tree.hess[k] == pytest.approx(h[mine].sum())
            assert tree.value[k] == pytest.approx(-0.3 * g[mine].sum() / (h[mine].sum() + 2.5))
        below = {k: {k} for k in range(len(tree.feature))}
        for k in reversed(range(len(tree.feature))):
            if tree.feature[k] >= 0:
                below[k] = below[tree.left[k]] | below[tree.right[k]]
                part = lambda nodes: (g[np.isin(leaf, list(nodes))].sum() ** 2) / (h[np.isin(leaf, list(nodes))].sum() + 2.5)
                want = part(below[tree.left[k]]) + part(below[tree.right[k]]) - part(below[k])
                assert tree.gain[k] == pytest.approx(want, rel=1e-6, abs=1e-9)
        margin += tree.value[leaf]
    assert model.margin(x) == pytest.approx(margin)


def test_weights_act_as_repeats(spark):
    df = table(spark, n=300)
    weighted = bo.fit(df.withColumn("w", F.when(F.col("label") == 1, 3.0).otherwise(1.0)), COLS, PLAIN, weight="w")
    _, y = matrix(df)
    p = 3 * y.sum() / (3 * y.sum() + (1 - y).sum())
    assert weighted.start == pytest.approx(np.log(p / (1 - p)))
    tree, (x, y) = weighted.trees[0], matrix(df)
    w = np.where(y == 1, 3.0, 1.0)
    mine = tree.leaves(x) == np.flatnonzero(tree.feature < 0)[0]
    assert tree.grad[tree.feature < 0][0] == pytest.approx((w * (p - y))[mine].sum())


def test_chunks_do_not_change_the_model_nor_let_plans_grow(spark, monkeypatch):
    df, sizes = table(spark, n=400), []
    real = bo._margin_rows
    monkeypatch.setattr(bo, "_margin_rows", lambda rows, path: sizes.append(rows._jdf.queryExecution().analyzed().toString().count("\n")) or real(rows, path))
    two, six = (bo.fit(df, COLS, bo.BoostParams(max_iter=12, max_depth=2, learning_rate=0.2, chunk=c)) for c in (2, 6))
    for a, b in zip(two.trees, six.trees, strict=True):
        assert a.feature.tolist() == b.feature.tolist() and a.value == pytest.approx(b.value)
    chunks_of_two = sizes[2:7]                                  # after the first, which starts from a constant
    assert max(chunks_of_two) == min(chunks_of_two)


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y != 1]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_staged_auc_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    y, m = rng.integers(0, 2, 300), np.round(rng.normal(size=(300, 4)) * 3, 1)
    m[:, 1] = np.round(m[:, 1] + y, 1)
    m[:, 3] = 50 * (2 * y - 1)                                  # beyond the histogram's ends
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(y, m, strict=True)], "y int, stages array<double>")
    got = {r.iteration: r.auc for r in bo.staged_auc(rows, "y", "stages").collect()}
    assert got == {k: pytest.approx(brute_auc(y, m[:, k])) for k in range(4)}
    one = bo.staged_auc(rows.where("y = 1"), "y", "stages").collect()
    assert all(r.auc is None for r in one)


def test_patience():
    stop = bo.Patience(3)
    assert [stop.tell(a) for a in (0.5, 0.7, None, 0.6, 0.7)] == [False, False, False, False, True]
    assert stop.best_at == 2
    never = bo.Patience(0)
    assert not any(never.tell(0.1) for _ in range(50))


def test_planted_overfit_stops_early(spark):
    """Labels of the held-out rows are noise: no tree helps after the first few."""
    rng = np.random.default_rng(6)
    rows = [(k, *map(float, rng.normal(size=3)), int(rng.random() < 0.5), k % 2) for k in range(400)]
    df = spark.createDataFrame(rows, "item_id long, a double, b double, c double, label int, part int")
    params = bo.BoostParams(max_iter=500, max_depth=3, learning_rate=0.3, min_rows_leaf=2, chunk=4)
    model = bo.fit(df, COLS, params, held=F.col("part") == 1, patience=6)
    assert len(model.trees) < 100
    aucs = [a for _, a in model.history]
    assert model.best_iteration == int(np.argmax(aucs)) + 1 and model.history[-1][0] - model.best_iteration == 6
    x, y = matrix(df.where("part = 1"))
    assert aucs[model.best_iteration - 1] == pytest.approx(brute_auc(y, model.margin(x)), abs=2e-3)


def test_nodes_scores_and_importance(spark):
    df = table(spark, n=600)
    models = [bo.fit(df, COLS, PLAIN, seed=s) for s in (1, 2)]
    nodes = models[0].nodes(spark)
    gain = {r.feature: r.importance for r in bo.gain_importance(nodes, [*COLS, "unused"]).collect()}
    want = dict.fromkeys([*COLS, "unused"], 0.0)
    for t in models[0].used():
        for f, g in zip(t.feature, t.gain, strict=True):
            if f >= 0:
                want[COLS[f]] += g
    assert gain == {k: pytest.approx(v) for k, v in want.items()}
    x, _ = matrix(df)
    p = np.mean([1 / (1 + np.exp(-m.margin(x))) for m in models], axis=0)
    got = [r.p for r in df.withColumn("p", bo.probability(models, COLS)).orderBy("item_id").collect()]
    assert got == pytest.approx(p)
    by_fold = df.withColumn("f", (F.col("item_id") % 2).cast("int")).withColumn("p", bo.probability(models, COLS, fold="f"))
    own = [1 / (1 + np.exp(-models[k % 2].margin(x[k:k + 1])[0])) for k in range(len(x))]
    assert [r.p for r in by_fold.orderBy("item_id").collect()] == pytest.approx(own)


def test_one_class_or_nothing_to_split(spark):
    ones = table(spark, n=50).withColumn("label", F.lit(1))
    assert bo.fit(ones, COLS, PLAIN).trees == []
    flat = table(spark, n=50).select("label", *(F.lit(1.0).alias(c) for c in COLS))
    model = bo.fit(flat, COLS, PLAIN)
    assert model.trees == [] and 0 < 1 / (1 + np.exp(-model.margin(np.ones((1, 3)))[0])) < 1
    with pytest.raises(ValueError):
        bo.fit(ones.limit(0), COLS, PLAIN)


def test_missing_values_go_right(spark):
    df = table(spark, n=300).withColumn("a", F.when(F.col("item_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("a")))
    model = bo.fit(df, COLS, PLAIN)
    x, _ = matrix(df)
    for tree in model.trees:
        leaf = tree.leaves(x)
        for k in np.flatnonzero(tree.feature < 0):
            assert tree.rows[k] == (leaf == k).sum()


def test_folds_side_by_side(spark):
    df = table(spark, n=600)
    res = scoring.kfold_train_predict(df, df, COLS, n_splits=3, preset="default", max_iter=12, early_stopping=4, balanced_groups=True)
    assert res.oof.groupBy("user_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    assert sorted(r["count"] for r in res.oof.groupBy("fold").count().collect()) == [200, 200, 200]
    assert {r.fold for r in res.nodes.select("fold").distinct().collect()} == {0, 1, 2}
    cut = {r.fold: r.iteration for r in scoring.fold_history(res).where("best").collect()}
    assert cut == {f: m.best_iteration for f, m in enumerate(res.models)}


def test_folds_share_their_jobs(spark):
    """A level of a tree is one job for all folds, not a dozen a fold and tree (r03: F1 to F7)."""
    df = table(spark, n=600).withColumn("fold", (F.col("item_id") % 3).cast("int")).cache()
    df.count()
    spark.sparkContext.setJobGroup("folds", "folds")
    try:
        models = bo.fit_folds(df, COLS, bo.BoostParams(max_iter=4, max_depth=3, learning_rate=0.3, min_rows_leaf=5), F.col("fold"), [1, 2, 3], patience=9)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("folds")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [len(m.trees) for m in models] == [4, 4, 4]
    assert 0 < len(jobs) <= 4 * 3 + 12                 # a tree's levels; start, sample, margins and AUC


def test_a_level_over_one_part_is_one_task(spark):
    """No shuffle where all rows lie in one part, and nothing but the trees' levels per tree (r03: F2 to F6)."""
    df = table(spark, n=600).withColumn("fold", (F.col("item_id") % 3).cast("int")).cache()
    df.count()
    stages = {}
    for trees in (2, 6):
        spark.sparkContext.setJobGroup(f"levels{trees}", "levels")
        try:
            bo.fit_folds(df, COLS, bo.BoostParams(max_iter=trees, max_depth=3, learning_rate=0.3, min_rows_leaf=5), F.col("fold"), [1, 2, 3])
            tracker = spark.sparkContext.statusTracker()
            stages[trees] = sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(f"levels{trees}"))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages[6] - stages[2] == 4 * 3


def test_a_small_level_is_one_stage(spark, monkeypatch):
    """Few small histograms need no shuffle, and give the splits that a shuffle gives (r03: F3 to F5)."""
    monkeypatch.setattr(bo, "FILE_ROWS", 100)
    df = table(spark, n=600).withColumn("fold", (F.col("item_id") % 3).cast("int")).cache()
    df.count()
    stages, models = {}, {}
    for name, trees, direct in (("a", 2, 16 << 20), ("b", 6, 16 << 20), ("c", 6, 0)):
        monkeypatch.setattr(bo, "DIRECT_BYTES", direct)
        spark.sparkContext.setJobGroup(f"small-{name}", "levels")
        try:
            models[name] = bo.fit_folds(df, COLS, bo.BoostParams(max_iter=trees, max_depth=3, learning_rate=0.3, min_rows_leaf=5), F.col("fold"), [1, 2, 3])
            tracker = spark.sparkContext.statusTracker()
            stages[name] = sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(f"small-{name}"))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages["b"] - stages["a"] == 4 * 3 and stages["c"] >= stages["b"] + 6 * 3
    for a, b in zip(models["b"], models["c"], strict=True):
        assert [(t.feature.tolist(), t.value.tolist()) for t in a.trees] == [(t.feature.tolist(), t.value.tolist()) for t in b.trees]


def test_rows_walk_to_their_leaves():
    rng = np.random.default_rng(9)
    bins = rng.integers(0, 9, (4, 700)).astype(np.uint8)
    tree = bo.Growth(0, [0, 1, 2, 3], [np.arange(8.0)] * 4)
    for _ in range(4):
        level, tree.open = tree.open, []
        for k in level:
            if k % 5 != 2:
                tree.split(k, int(rng.integers(4)), int(rng.integers(8)), (1, 1.0, 1.0), (1, 1.0, 1.0))
    want = []
    for row in bins.T:
        k = 0
        while tree.feature[k] >= 0:
            k = (tree.left if row[tree.feature[k]] <= tree.cut[k] else tree.right)[k]
        want.append(k)
    assert tree.at(bins).tolist() == want


def test_draws_equal_sparks_hash(spark):
    ids = spark.range(500).select(F.xxhash64("id", F.lit(7)).alias("seeded"), F.xxhash64("id", F.lit(7), F.lit(1999)).alias("drawn")).collect()
    assert bo.hashed_on(np.array([r.seeded for r in ids]), 1999).tolist() == [r.drawn for r in ids]


def test_places_stand_for_values(spark):
    """Bins and leaves looked up by place are those of the values, equal and missing ones too."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 2)), 1)
    x[::9, 1] = bo.MISSING
    points, places = zip(*(np.unique(x[:, k], return_inverse=True) for k in range(2)), strict=True)
    block = bo._Block({"n": 400, "places": np.array(places, np.uint16).tobytes(), "sizes": np.array([len(p) for p in points], np.int32).tobytes(),
                       "points": np.concatenate(points).tobytes(), "y": np.zeros(400).tobytes(), "w": np.ones(400).tobytes(),
                       "held": np.zeros(400, np.int32).tobytes(), "draw": np.zeros(400, np.int64).tobytes(), "margin": np.zeros(400).tobytes()}, 2, 1)
    none, rows = np.zeros(5), np.arange(0, 400, 3)
    tree = bo.Tree(np.array([0, 1, -1, -1, -1]), np.array([0.3, -0.25, np.nan, np.nan, np.nan]), np.array([1, 2, -1, -1, -1]),
                   np.array([4, 3, -1, -1, -1]), np.array([0, 0, 1.0, 2, 3]), none, none, none, none)
    assert block.gains(tree, rows).tolist() == tree.value[tree.leaves(x[rows])].tolist()
    for c, thresholds in enumerate((np.array([-0.5, 0.3, 0.35]), np.array([-0.25, 9.0]))):
        assert block.bins(c, rows, thresholds, np.uint8).tolist() == np.searchsorted(thresholds, x[rows, c], "left").tolist()


def test_folds_grown_together_equal_those_grown_alone(spark):
    df = table(spark, n=500).withColumn("fold", (F.col("item_id") % 2).cast("int"))
    params = bo.BoostParams(max_iter=5, max_depth=3, learning_rate=0.3, min_rows_leaf=5, subsample=0.8, feature_share=0.7, chunk=2)
    both = bo.fit_folds(df, COLS, params, F.col("fold"), [7, 8], patience=3)
    for m, model in enumerate(both):
        alone = bo.fit(df, COLS, params, held=F.col("fold") == m, patience=3, seed=7 + m)
        assert [t.feature.tolist() for t in alone.trees] == [t.feature.tolist() for t in model.trees]
        assert all(a.value == pytest.approx(b.value) and a.threshold == pytest.approx(b.threshold, nan_ok=True)
                   for a, b in zip(alone.trees, model.trees, strict=True))
        assert [a for _, a in alone.history] == pytest.approx([a for _, a in model.history]) and alone.best_iteration == model.best_iteration


def test_first_split_is_the_best_of_all(spark):
    df = table(spark, n=60)
    x, y = matrix(df)
    tree = bo.fit(df, COLS, bo.BoostParams(max_iter=1, max_depth=1, learning_rate=0.3, min_rows_leaf=5)).trees[0]
    p = y.mean()
    g, h, best = p - y, np.full(len(y), p * (1 - p)), []
    for c in range(3):
        v = np.unique(x[:, c])
        for t in (v[:-1] + v[1:]) / 2:
            left = x[:, c] <= t
            if min(left.sum(), (~left).sum()) >= 5:
                best.append((sum(g[s].sum() ** 2 / h[s].sum() for s in (left, ~left)), c, t))
    _, feature, threshold = max(best)
    assert (tree.feature[0], tree.threshold[0]) == (feature, pytest.approx(threshold))


def test_split_candidates():
    values = np.array([0.0, 1, 2, 10])
    assert bo.split_candidates(values, np.ones(4), 3).tolist() == [0.5, 1.5, 6]
    assert bo.split_candidates(values, np.ones(4), 1).tolist() == [1.5]
    assert bo.split_candidates(values, np.array([9.0, 1, 1, 1]), 1).tolist() == [0.5]
    assert bo.split_candidates(values[:1], np.ones(1), 3).tolist() == []
    many = bo.split_candidates(np.arange(1000.0), np.ones(1000), 9)
    assert len(many) == 9 and np.abs(np.diff(many) - 100).max() <= 1

"""Radix selection: exact cuts of several groups without moving the wide rows."""

import random

import pytest
from pyspark.sql import functions as F

from cartwheel.functions import selection
from cartwheel.functions.exprs import hash_order
from cartwheel.operators import sampling as sm
from cartwheel.session import materialize

def key():
    return hash_order(7, "user_id", "item_id")


def md5(row):
    import hashlib
    return hashlib.md5(f"{row['user_id']}_{row['item_id']}_7".encode()).hexdigest()


@pytest.fixture(scope="module")
def wide(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(40), rng.randrange(60), rng.choice([0, 0, 0, 1, 1, 2, None]), k) for k in range(3000)]
    rows += [(3, 3, 0, k) for k in range(1000)]                 # a pair with a quarter of the rows
    return spark.createDataFrame(rows, "user_id long, item_id long, g int, payload int").repartition(6).cache()


def brute(rows, quotas):
    """How many rows of each (group, pair) are inside."""
    out = {}
    for g, n in quotas.items():
        mine = sorted((r for r in rows if r["g"] == g), key=lambda r: (md5(r), r["user_id"], r["item_id"]))
        for r in mine[:max(n, 0)]:
            k = (g, r["user_id"], r["item_id"])
            out[k] = out.get(k, 0) + 1
    return out


@pytest.mark.parametrize("cell_rows", [selection.CELL_ROWS, 1])
@pytest.mark.parametrize("quotas", [{0: 1, 1: 500, 2: 10**6}, {0: 1700, 1: 0, 2: 3}, {1: 77, 9: 5}])
def test_cut_equals_brute_force(wide, monkeypatch, quotas, cell_rows):
    monkeypatch.setattr(selection, "CELL_ROWS", cell_rows)
    cut = selection.first_of_groups(wide, F.col("g"), key(), ["user_id", "item_id"], lambda n: quotas)
    rows = [r.asDict() for r in wide.collect()]
    got = {}
    for r in cut.of(wide).collect():
        k = (r.g, r.user_id, r.item_id)
        got[k] = got.get(k, 0) + 1
    assert got == brute(rows, quotas)
    assert cut.totals == {g: sum(r["g"] == g for r in rows) for g in (0, 1, 2)}


def test_a_cut_inside_equal_rows_is_exact(wide):
    """The hot pair straddles the cut: some of its equal rows are inside."""
    rows = [r.asDict() for r in wide.collect() if r.g == 0]
    before = sum((md5(r), r["user_id"], r["item_id"]) < (md5({"user_id": 3, "item_id": 3}), 3, 3) for r in rows)
    n = before + 400
    cut = selection.first_of_groups(wide, F.col("g"), key(), ["user_id", "item_id"], lambda t: {0: n})
    first, again = (sorted(r.payload for r in cut.of(wide).collect()) for _ in range(2))
    assert len(first) == n and first == again


def test_the_wide_rows_are_only_filtered(spark, wide):
    cut = selection.first_of_groups(wide.where("payload < 3000"), F.col("g"), hash_order(1, "user_id", "item_id", "payload"),
                                    ["user_id", "item_id", "payload"], lambda n: {0: 30, 1: 20})
    plan = cut.of(materialize(wide, "wide"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


@pytest.mark.parametrize("cell_rows", [selection.CELL_ROWS, 1])
def test_rank_cells_equals_row_number(wide, monkeypatch, cell_rows):
    monkeypatch.setattr(selection, "CELL_ROWS", cell_rows)
    got = selection.rank_cells(wide, F.col("g"), key(), ["user_id", "item_id"], "rank")
    assert got.columns == [*wide.columns, "rank"] or set(got.columns) == {*wide.columns, "rank"}
    ranks = {}
    for r in got.collect():
        ranks.setdefault(r.g, []).append((r["rank"], md5(r.asDict()), r.user_id, r.item_id))
    assert all(x[0] is None for x in ranks.pop(None))
    for rows in ranks.values():
        rows.sort()
        assert [x[0] for x in rows] == list(range(1, len(rows) + 1))
        assert [x[1:] for x in rows] == sorted(x[1:] for x in rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], "user_id long, item_id long, g int")
    cut = selection.first_of_groups(none, F.col("g"), key(), ["user_id"], lambda n: {0: 5})
    assert cut.totals == {} and cut.of(none).count() == 0
    assert selection.rank_cells(none, F.col("g"), key(), ["user_id"], "r").count() == 0


def _labelled(spark, n=4000):
    rng = random.Random(9)
    rows = {}
    for _ in range(n):
        user = 1 if rng.random() < 0.4 else rng.randrange(2, 200)
        rows[(user, rng.randrange(10_000))] = (1 if rng.random() < 0.05 else 0, rng.choice([0, 1, 2, 3, 5, 9, 999, None]))
    data = [(u, i, *v, f"x{k}") for k, ((u, i), v) in enumerate(rows.items())]
    return spark.createDataFrame(data, "user_id long, item_id long, label int, ui_days_since_last_action int, wide string").cache()


@pytest.mark.parametrize("cell_rows", [sm.CELL_ROWS, 50])
def test_by_user_shares_with_a_hot_user(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(sm, "CELL_ROWS", cell_rows)
    df = _labelled(spark)
    import hashlib
    rows = [r.asDict() for r in df.collect()]
    order = lambda r: (hashlib.md5(f"{r['user_id']}_{r['item_id']}_42".encode()).hexdigest(), r["user_id"], r["item_id"])
    neg = [r for r in rows if r["label"] == 0]
    target = min(len(neg), int((len(rows) - len(neg)) * 3))
    picked = []
    for user in {r["user_id"] for r in neg}:
        mine = sorted((r for r in neg if r["user_id"] == user), key=order)
        picked += mine[:min(len(mine), round(len(mine) / len(neg) * target))]
    want = {(r["user_id"], r["item_id"]) for r in sorted(picked, key=order)[:target]} | {(r["user_id"], r["item_id"]) for r in rows if r["label"] == 1}
    got = sm.downsample_negatives(df, neg_pos_ratio=3, by_user=True)
    assert got.columns == df.columns
    assert sorted((r.user_id, r.item_id) for r in got.collect()) == sorted(want)


def test_all_buckets_are_cut_by_one_filter(spark):
    df = _labelled(spark)
    out = sm.downsample_negatives_bucketed(df, neg_pos_ratio=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Union" not in plan
    pos = {r["b"]: r["n"] for r in sm.recency_bucket(df.where("label = 1"), col="b").groupBy("b").agg(F.count("*").alias("n")).collect()}
    neg = {r["b"]: r["n"] for r in sm.recency_bucket(df.where("label = 0"), col="b").groupBy("b").agg(F.count("*").alias("n")).collect()}
    got = {r["b"]: r["n"] for r in sm.recency_bucket(out.where("label = 0"), col="b").groupBy("b").agg(F.count("*").alias("n")).collect()}
    assert got == {b: min(neg[b], 2 * n) for b, n in pos.items()}


def test_user_sample_is_a_filter_on_the_user(spark):
    df = _labelled(spark)
    out = sm.user_sample(df, 0.1)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    users = df.select("user_id").distinct().count()
    assert out.select("user_id").distinct().count() == int(users * 0.1)


def greedy(sizes, k):
    load, out = [0] * k, []
    for s in sorted(sizes, reverse=True):
        f = load.index(min(load))
        load[f] += s
        out.append((s, f))
    return load, out


@pytest.mark.parametrize("seed", range(6))
def test_dealing_by_sizes_equals_the_greedy_loop(seed):
    rng = random.Random(seed)
    k = rng.randrange(1, 7)
    sizes = [rng.choice([1, 1, 1, 2, 3, 5, rng.randrange(1, 400)]) for _ in range(rng.randrange(1, 800))] + [9000] * (seed % 2)
    histogram = [(s, sizes.count(s)) for s in set(sizes)]
    load, want = greedy(sizes, k)
    got = [(s, turn[j % len(turn)]) for s, a, b, turn in sm.deal_sizes(histogram, k) for j in range(b - a + 1)]
    assert got == want


def test_balanced_folds(spark):
    df = _labelled(spark)
    out = sm.group_kfold_balanced(df, 4)
    assert out.count() == df.count() and out.columns == [*df.columns, "fold"]
    assert out.groupBy("user_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    sizes = [r["n"] for r in df.groupBy("user_id").agg(F.count("*").alias("n")).collect()]
    assert sorted(r["n"] for r in out.groupBy("fold").agg(F.count("*").alias("n")).collect()) == sorted(greedy(sizes, 4)[0])

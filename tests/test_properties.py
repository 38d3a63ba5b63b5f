"""Decision operators against plain Python loops on random cases (many users
per DataFrame, so one Spark job checks many cases)."""

import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import recall, tuning
from cartwheel.operators import strategies as st


def _two_stage_loop(rows, k, m):
    """Per user: best min(m, #strong, k) strong items, then best weak up to k."""
    out = set()
    users = {}
    for u, i, p, s in rows:
        users.setdefault(u, []).append((p, i, s))
    for u, items in users.items():
        strong = sorted([(-p, i) for p, i, s in items if s])
        weak = sorted([(-p, i) for p, i, s in items if not s])
        k1 = min(m, len(strong), k)
        out |= {(u, i) for _, i in strong[:k1]}
        out |= {(u, i) for _, i in weak[:k - k1]}
    return out


@pytest.fixture(scope="module")
def cases(spark):
    rnd = random.Random(11)
    rows = []
    for u in range(300):
        for i in range(rnd.randint(0, 25)):
            rows.append((u, i, rnd.randint(0, 9) / 10.0, rnd.random() < rnd.random()))
    # one hot user with about a third of all rows
    for i in range(len(rows) // 2):
        rows.append((999, i, rnd.randint(0, 99) / 100.0, rnd.random() < 0.2))
    return rows


@pytest.mark.parametrize("k,m", [(3, 0), (3, 1), (5, 2), (8, 5), (15, 3), (1, 5)])
def test_two_stage_matches_loop(spark, cases, k, m):
    df = spark.createDataFrame(cases, "user_id bigint, item_id bigint, pred_prob double, s boolean")
    res = df.select("user_id", "item_id", "pred_prob")
    strong = df.where("s").select("user_id", "item_id")
    got = {(r.user_id, r.item_id) for r in st.two_stage(res, strong, k, m).collect()}
    assert got == _two_stage_loop(cases, k, m)


def test_grid_matches_per_point(spark, cases):
    rnd = random.Random(5)
    rows = [(u, i, p, int(rnd.random() < 0.3), int(s), 0, 0, 9, 0) for u, i, p, s in cases]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, pred_prob double, label int, "
                                     "ui_cart_count bigint, ui_collect_count bigint, recent_3d_actions bigint, "
                                     "ui_days_since_last_action int, ui_purchase_count bigint")
    grid = {(r.k, r.m): (r.tp, r.pred_cnt, r.true_pos) for r in tuning.grid_two_stage(df).collect()}
    assert len(grid) == 29
    lab = {(u, i): l for u, i, _, l, *_ in rows}
    flat = [(u, i, p, bool(c)) for u, i, p, _, c, *_ in rows]
    for (k, m), (tp, cnt, tpos) in grid.items():
        picked = _two_stage_loop(flat, k, m)
        assert cnt == len(picked)
        assert tp == sum(lab[x] for x in picked)
        assert tpos == sum(lab.values())


def test_priority_cap_matches_loop(spark):
    rnd = random.Random(3)
    rows = []
    for u in range(200):
        for i in range(rnd.randint(1, 30)):
            rows.append((u, i, rnd.random() < 0.3, rnd.random() < 0.3, rnd.random() < 0.1))
    for i in range(len(rows) // 2):                      # hot user: a third of the rows
        rows.append((999, i, rnd.random() < 0.3, rnd.random() < 0.3, rnd.random() < 0.1))
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, t_recent boolean, t_strong boolean, t_label boolean")
    for cap in (1, 4, 10):
        got = {(r.user_id, r.item_id, r.label) for r in
               recall.train_candidates(df, cap, align_recall=False).collect()}
        want = set()
        by_user = {}
        for u, i, rec, strg, lab in rows:
            tier = 0 if lab else 1 if strg else 2 if rec else None
            if tier is not None:
                by_user.setdefault(u, []).append((tier, i, int(lab)))
        for u, items in by_user.items():
            want |= {(u, i, lab) for _, i, lab in sorted(items)[:cap]}
        assert got == want


@pytest.mark.parametrize("max_rows,dmax", [(0, 3), (5, 3), (20, 3), (60, 2), (1000, 1), (40, 3)])
def test_cart_ladder_matches_loop(spark, max_rows, dmax):
    rnd = random.Random(max_rows + dmax)
    rows = [(u, i, rnd.randint(0, 2), rnd.randint(0, 6), rnd.randint(0, 20) / 20.0)
            for u in range(40) for i in range(5)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, ui_cart_count bigint, "
                                     "ui_days_since_last_action int, pred_prob double")
    got = {(r.user_id, r.item_id) for r in
           st.cart_only(df, df.select("user_id", "item_id", "pred_prob"), max_rows=max_rows, cart_days_max=dmax).collect()}
    pool = [(u, i, g, p) for u, i, c, g, p in rows if c > 0]

    def count(d):
        return sum(1 for *_, g, _p in pool if g <= d)
    d = 1
    for nxt in (2, 3):
        if nxt > dmax or (max_rows and count(d) >= max_rows):
            break
        d = nxt
    chosen = sorted([(-p, u, i) for u, i, g, p in pool if g <= d])
    if max_rows:
        chosen = chosen[:max_rows]
    assert got == {(u, i) for _, u, i in chosen}

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import hard_negatives as hn
from cartwheel.llm.queries import op11_hard_negatives
from cartwheel.llm.sql import ORACLE
from tests.oracle_compare import compare, duck

SCHEMA = "vec_id long, label int, embedding array<double>, score int"


def brute(rows, asked, positives=5, negatives=3, low=50, high=95):
    ok = {(i, lab, tuple(int(math.floor(256 * x)) for x in v)) for i, lab, v in rows
          if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    ok = [r for r in ok if sum(x * x for x in r[2]) < 2 ** 62]
    if not ok:
        return []
    sizes = [len(r[2]) for r in ok]
    dim = min(set(sizes), key=lambda d: (-sizes.count(d), d))
    ok = [r for r in ok if len(r[2]) == dim]
    out = []
    for i, lab, z in ok:
        if not asked(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(z, w, strict=True)), j, lj) for j, lj, w in ok if j != i)
        for s, p, _ in [x for x in scored if x[2] == lab][:positives]:
            ps = -s
            fit = [(-n, j) for n, j, lj in scored if lj != lab and low * ps <= -100 * n <= high * ps][:negatives]
            out += [(i, p, r + 1, j, ps, ns) for r, (ns, j) in enumerate(fit)]
    return sorted(out)


def found(frame):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in frame.collect())


def clustered(n, dim, seed, spread=0.25, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(k, int(rng.integers(labels)), (centres[k % 6] + spread * rng.normal(size=dim)).tolist()) for k in range(n)]


def mine(spark, rows, **kw):
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    return hn.mine(frame, lambda i: F.pmod(i, F.lit(10)) == 0, **kw)


@pytest.mark.parametrize("seed,dim", [(1, 4), (2, 16)])
def test_clusters_equal_brute_force(spark, monkeypatch, seed, dim):
    # Small shards, leaves and blocks: many nodes, many visits.
    for name, value in (("SHARD", 32), ("LEAF", 4), ("FAN", 3), ("QBLOCK", 8), ("STEP", 2)):
        monkeypatch.setattr(hn, name, value)
    rows = clustered(700, dim, seed)
    assert found(mine(spark, rows)) == brute(rows, lambda i: i % 10 == 0)


def test_ties_repeats_hot_vectors_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "SHARD", 16)
    rng = np.random.default_rng(3)
    rows = [(k, k % 3, [1.0, 0.5, 0.25] if k % 3 == 0 else rng.normal(size=3).round(1).tolist()) for k in range(240)]
    rows += [(k, 7, [1.0, 0.5, 0.25]) for k in range(1000, 1030)] + [(1000, 2, [1.0, 0.5, 0.25])] * 4
    rows += [(2000, 1, [0.0, 0.0, 0.0]), (2010, None, [1.0, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (2020, 1, None), (2030, 1, []),
             (2040, 1, [1.0, None, 1.0]), (2050, 1, [1.0, float("nan"), 1.0]), (2060, 1, [1.0, float("inf"), 1.0]),
             (2070, 1, [1.0, 2.0]), (2080, 1, [1e300, 1.0, 1.0]), (2090, 1, [9e6, 1.0, 1.0]), (2100, 2, [8e6, -1.0, 3.0])]
    assert found(mine(spark, rows)) == brute(rows, lambda i: i % 10 == 0)


def test_few_rows_and_none(spark):
    for rows in ([], [(10, 1, [1.0])], [(10, 1, [1.0]), (11, 1, [2.0])], [(1, 1, [1.0]), (2, 2, [1.0])],
                 [(10, 1, [1.0]), (11, 1, [2.0]), (12, 2, [1.5]), (13, 2, [1.9])], [(10, 1, [1.0]), (11, 1, [-2.0]), (12, 2, [-1.5])]):
        assert found(mine(spark, rows)) == brute(rows, lambda i: i % 10 == 0), rows


def test_tree_covers_its_rows_and_bounds_hold():
    rng = np.random.default_rng(8)
    x = np.floor(256 * np.array([v for _, _, v in clustered(900, 5, 8)]))
    m2 = (x * x).sum(axis=1).max()
    order, nodes, radii = hn.cover_tree(x, m2)
    z = x[order]
    assert sorted(order) == list(range(len(x)))
    leaves = nodes[nodes[:, 4] == 1]
    assert sorted((s, e) for _, s, e, _, _ in leaves)[0][0] == 0 and (leaves[:, 2] - leaves[:, 1]).sum() == len(x)
    q = np.floor(256 * rng.normal(size=(20, 5)))
    upper, lower = hn._bounds(q, m2, z, nodes, radii)
    for k, (_, s, e, _, _) in enumerate(nodes):
        score = q @ z[s:e].T
        assert (score.max(axis=1) <= upper[:, k]).all() and (score.min(axis=1) >= lower[:, k]).all()


def test_clusters_far_away_are_skipped(monkeypatch):
    """The leaves verified are those whose bounds reach the floors."""
    rows = clustered(3000, 8, 5, spread=0.02, labels=2)
    x, label = np.floor(256 * np.array([v for _, _, v in rows])), np.array([r[1] for r in rows])
    m2 = (x * x).sum(axis=1).max()
    order, nodes, radii = hn.cover_tree(x, m2)
    tree = (x[order], label[order], order, nodes, radii)
    seen = []
    real = np.nonzero
    monkeypatch.setattr(hn.np, "nonzero", lambda m: seen.append(m.size) or real(m))
    best = hn.search_block(x[:10], label[:10], np.full((10, 1), -np.inf), np.full((10, 1), np.inf), [tree], 6, True, m2)
    monkeypatch.undo()
    for k in range(10):
        s = x @ x[k]
        want = sorted((-s[j], j) for j in range(len(x)) if label[j] == label[k])[:6]
        assert [(-a, b) for a, b in zip(best.score[best.slot == k], best.id[best.slot == k], strict=True)] == [(a, b) for a, b in want]
    assert sum(seen) < 10 * len(x) / 2


def test_query_matches_sql(spark, sf):
    r = compare(spark, duck(sf), "op11_hard_negatives", op11_hard_negatives, ORACLE["op11_hard_negatives"], sf)
    assert r["status"] == "match", r

import numpy as np
import pytest

from cartwheel.llm import ann
from cartwheel.llm.queries import op9_nearest


def brute(rows, asked, k=5):
    """query -> [(vec_id, score)], all pairs compared."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero([asked(i) for i in ids]):
        score = x @ x[q]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, want = found(op9_nearest(spark, folder)), brute(rows, lambda i: i % 50 == 0)
    assert got.keys() == want.keys() and all(len(g) == 5 for g in got.values())
    assert recall(got, want) >= 0.95
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, near in got.items():
        assert near == sorted(near, key=lambda n: (-n[1], n[0]))
        for v, score in near:
            a, b = vectors[q], vectors[v]
            assert score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)


def test_hot_vector_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [1.0, 2.0, 3.0, 4.0] if k % 3 == 0 else rng.normal(size=4).tolist()) for k in range(300)]
    odd = [(1000, None), (1050, [0.0] * 4), (1100, [1.0, None, 2.0, 3.0]), (1150, [float("nan")] * 4),
           (1200, [float("inf"), 1.0, 1.0, 1.0]), (1250, []), (1300, [1.0, 2.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    frame = spark.createDataFrame([(*r, 0.5) for r in rows + odd], "vec_id long, embedding array<double>, score double")
    got, want = found(ann.nearest(frame, lambda i: i % 50 == 0)), brute(rows, lambda i: i % 50 == 0)
    assert got.keys() == want.keys()
    assert [v for v, _ in got[0]] == [3, 6, 9, 12, 15] and [v for v, _ in got[150]] == [0, 3, 6, 9, 12]
    assert recall(got, want) == 1.0


def test_few_repeated_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])], schema)
    got = found(ann.nearest(frame, lambda i: i % 50 == 0))
    assert [v for v, _ in got[0]] == [7, 7, 50] and [v for v, _ in got[50]] == [7, 7, 0]
    assert found(ann.nearest(frame.where("vec_id = 0"), lambda i: i % 50 == 0)) == {}
    assert found(ann.nearest(frame.limit(0), lambda i: i % 50 == 0)) == {}


def test_huge_and_tiny_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 1e-200]), (2, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(ann.nearest(frame, lambda i: i % 50 == 0))
    assert [v for v, _ in got[0]] == [1, 2] and got[0][0][1] == pytest.approx(1.0)

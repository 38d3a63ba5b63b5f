"""Distributed ranking helpers against brute force (pandas), with ties and a
group that holds most of the rows, under several partition counts."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwheel.functions.ranking import (
    global_cum_sum, global_row_number, row_number_within, take_first, top_k_per_group,
)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = 0 if rnd.random() < 0.6 else rnd.randint(1, 40)     # group 0 holds ~60 %
        rows.append((g, i, rnd.randint(0, 50) / 10.0))          # many score ties
    return rows, spark.createDataFrame(rows, "g bigint, id bigint, s double")


@pytest.mark.parametrize("parts", [1, 4, 200])
def test_global_row_number(data, parts):
    rows, df = data
    got = {r.id: r.grn for r in global_row_number(df, [F.col("s").desc(), F.col("id")], num_partitions=parts).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "id", "s"]).sort_values(["s", "id"], ascending=[False, True])
    want = {i: n + 1 for n, i in enumerate(pdf["id"])}
    assert got == want


@pytest.mark.parametrize("parts", [3, 50])
def test_row_number_within(data, parts):
    rows, df = data
    got = {r.id: r.rn for r in row_number_within(df, ["g"], [F.col("s"), F.col("id")], num_partitions=parts).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "id", "s"]).sort_values(["g", "s", "id"])
    pdf["rn"] = pdf.groupby("g").cumcount() + 1
    assert got == dict(zip(pdf["id"], pdf["rn"]))


@pytest.mark.parametrize("k", [1, 5, 1200])
def test_top_k_per_group(data, k):
    rows, df = data
    got = sorted((r.g, r.id, r.rn) for r in top_k_per_group(df, ["g"], [F.col("s").desc(), F.col("id")], k).collect())
    pdf = pd.DataFrame(rows, columns=["g", "id", "s"]).sort_values(["g", "s", "id"], ascending=[True, False, True])
    pdf["rn"] = pdf.groupby("g").cumcount() + 1
    want = sorted(tuple(x) for x in pdf[pdf.rn <= k][["g", "id", "rn"]].itertuples(index=False))
    assert got == want


def test_global_cum_sum(data):
    rows, df = data
    got = {r.id: r.cum_before for r in global_cum_sum(df, [F.col("s"), F.col("id")], "g", num_partitions=7).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "id", "s"]).sort_values(["s", "id"])
    pdf["cb"] = pdf["g"].cumsum() - pdf["g"]
    assert got == dict(zip(pdf["id"], pdf["cb"]))


def test_take_first(data):
    rows, df = data
    got = sorted(r.id for r in take_first(df, 25, [F.col("s").desc(), F.col("id")]).collect())
    pdf = pd.DataFrame(rows, columns=["g", "id", "s"]).sort_values(["s", "id"], ascending=[False, True])
    assert got == sorted(pdf["id"].head(25))
    assert take_first(df, 0, [F.col("id")]).count() == len(rows)


@pytest.mark.parametrize("n", [1, 7, 25, 400, 2999, 5000])
def test_take_first_with_score_floor(data, n):
    rows, df = data
    got = sorted(r.id for r in take_first(df, n, [F.col("s").desc(), F.col("id")], score_col="s").collect())
    pdf = pd.DataFrame(rows, columns=["g", "id", "s"]).sort_values(["s", "id"], ascending=[False, True])
    assert got == sorted(pdf["id"].head(n))


@pytest.mark.parametrize("n", [1, 30, 700])
def test_take_first_with_hash_lead(spark, n):
    from cartwheel.functions.exprs import hash_order, hash_prefix
    df = spark.range(3000).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("item_id"))
    order = [hash_order(42, "user_id", "item_id"), F.col("user_id"), F.col("item_id")]
    got = sorted(r.user_id for r in take_first(df, n, order, lead=(hash_prefix(42, "user_id", "item_id"), False)).collect())
    want = sorted(r.user_id for r in df.orderBy(*order).limit(n).collect())
    assert got == want


@pytest.mark.parametrize("qs", [[0.5], [0.9, 0.999], [0.0, 1.0, 0.25, 1e-6]])
def test_exact_quantiles(spark, data, qs):
    import numpy as np
    from cartwheel.operators.strategies import exact_quantiles
    rows, df = data
    got = exact_quantiles(df, "s", qs).first()
    vals = np.array([r[2] for r in rows])
    for j, q in enumerate(qs):
        assert got[f"q{j}"] == pytest.approx(float(np.quantile(vals, q)), abs=1e-12)


def test_exact_quantiles_many_distinct(spark):
    import numpy as np
    from cartwheel.operators.strategies import exact_quantiles
    rnd = random.Random(2)
    vals = [rnd.random() for _ in range(20000)]
    df = spark.createDataFrame([(x,) for x in vals], "s double")
    got = exact_quantiles(df, "s", [0.9, 0.999, 0.3]).first()
    for j, q in enumerate([0.9, 0.999, 0.3]):
        assert got[f"q{j}"] == pytest.approx(float(np.quantile(np.array(vals), q)), abs=1e-12)


@pytest.mark.parametrize("width", [0.0, -0.01])
def test_exact_quantiles_fallback_paths(spark, monkeypatch, width):
    """Degenerate (0) or inverted (-0.01) brackets fail their check for some or
    all targets; the result must still be exact."""
    import numpy as np
    from cartwheel.operators import strategies
    monkeypatch.setattr(strategies, "_BRACKET", width)
    rnd = random.Random(9)
    vals = [rnd.random() for _ in range(5000)]
    df = spark.createDataFrame([(x,) for x in vals], "s double")
    qs = [0.5, 0.9, 0.999, 0.0, 1.0]
    got = strategies.exact_quantiles(df, "s", qs).first()
    for j, q in enumerate(qs):
        assert got[f"q{j}"] == pytest.approx(float(np.quantile(np.array(vals), q)), abs=1e-12)

"""Every registered query against its DuckDB oracle (row count, columns,
order-insensitive value hash), as the driver checks it; sf0.001 for speed.
Set CARTWHEEL_ORACLE_SF to another folder to run the same check there."""

import os

import pytest

import __spark_entry__ as E
import tests.oracle_compare as oc
from cartwheel.plans.catalog import QUERIES as OWN
from tests.oracle_compare import compare, duck

oc.EXACT = True          # hash doubles bit for bit, as a strict driver would

SF = os.environ.get("CARTWHEEL_ORACLE_SF", "/root/testdata/sf0.001")
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in OWN}
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_or_is_model():
    rows_only = set(OWN) - set(ORACLE)
    assert rows_only == {"oof_scores", "pred_scores", "feature_importance", "pruned_features", "pca_embedding",
                         "model_nodes", "fold_history", "prune_retrain"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], ORACLE[name], SF)
    assert r["status"] == "match", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "label" in df.columns and len(df.columns) == 35

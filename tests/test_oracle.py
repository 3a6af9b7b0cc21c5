"""Every registered query with a DuckDB twin agrees with it (sf0.001)."""

import pytest

import __spark_entry__ as entry_mod
from tagweave.plans.catalog import QUERIES as CATALOG
from conftest import SF_SMALL
from oracle_harness import compare, duck

QUERIES = entry_mod.queries()
# the training-data queries have tests of their own in tests/llm
ORACLE = {k: v for k, v in entry_mod.oracle_sql().items() if k in CATALOG}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, con, name):
    ok, n, _, _, detail = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, f"{name}: {detail}"


def test_every_query_is_registered_with_a_callable():
    assert set(ORACLE) <= set(QUERIES)
    missing = sorted(set(CATALOG) - set(ORACLE))
    assert missing == ["model_confusion", "sample_bernoulli", "sentiment_model"]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["id", "degree", "dominant_sentiment"]
    assert df.count() > 0

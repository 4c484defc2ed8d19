"""Every registered query against its DuckDB oracle (sf0.001 here; the
driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from loanlake.plans.catalog import QUERIES
from oracle_compare import compare, duck
from conftest import SF_SMALL

NAMES = sorted(set(E.oracle_sql()) & set(QUERIES))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["match"], r
    assert not r.get("types"), r


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) & set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "composite_risk_score" in df.columns

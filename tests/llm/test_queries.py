"""The registered queries against their DuckDB SQL."""

import pytest

from conftest import SF_SMALL
from loanlake.llm.queries import ORACLE, QUERIES
from oracle_compare import compare


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(spark, name, SF_SMALL)
    assert r["match"], r


def test_every_dealt_operator_is_registered():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13

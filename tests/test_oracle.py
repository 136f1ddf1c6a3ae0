"""Every registered query against its DuckDB SQL on the same tables (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.oracle import compare, duck
from tests.conftest import SF_SMALL

QUERIES = {k: f for k, f in E.queries().items() if k not in E.LLM_QUERIES}
ORACLE = {k: q for k, q in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["received"] == 896


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert not problems, problems

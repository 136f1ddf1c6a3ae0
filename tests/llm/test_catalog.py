"""Registered queries against their SQL on the given tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck
from tidemark.llm.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    problems, n = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert not problems and n, problems


def test_all_are_registered():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())

"""queries() against oracle_sql() on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = os.environ.get("TESSERA_ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert not problems, problems


def test_every_query_has_an_oracle():
    from tessera.plans import entry_queries
    assert set(entry_queries.QUERIES) == set(entry_queries.ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["primary_type", "total", "prisoes", "taxa_prisao_pct"]
    assert df.count() > 0

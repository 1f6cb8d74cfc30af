"""Every registered query against its DuckDB oracle (sf0.001; the driver
runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from harness import compare, duck
from conftest import SF_SMALL
from tiermill.plans.catalog import QUERIES
from tiermill.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["department", "job", "Q1", "Q2", "Q3", "Q4", "total_hires"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert not problems, problems

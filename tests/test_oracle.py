"""Every query with an oracle statement equals it on the smallest scale;
queries without one run and return rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import __spark_entry__ as se  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = se.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, detail = compare(spark, con, name, se.queries()[name], SQL[name], SF)
    assert ok, detail


@pytest.mark.parametrize("name", sorted(set(se.queries()) - set(SQL)))
def test_rows_only_query_runs(spark, name):
    assert se.queries()[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["Order_uuid", "bundle_time", "id", "status", "total"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(SQL) <= set(se.queries())

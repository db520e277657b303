"""Every registered query against its DuckDB statement, or at least to its end."""

import __spark_entry__ as contract
import oracle_check
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(name, spark, con):
    df = contract.queries()[name](spark, SF)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
        return
    ok, note = oracle_check.compare(df, con, sql)
    assert ok, note


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1

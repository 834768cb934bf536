import pytest

import __spark_entry__ as contract
from compare import differences, open_tables, type_differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return open_tables(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    sql = contract.oracle_sql()[name]
    assert not type_differences(df, con, sql)
    assert not differences(df, con, sql)


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    days = [r.dt for r in df.select("dt").collect()]
    assert days == sorted(days) and len(days) == 1402

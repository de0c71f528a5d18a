import pytest
from oracle_check import connect, difference

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = con.execute(contract.oracle_sql()[name]).df()
    assert difference(got, want) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["ticker", "event_time", "seq"]
    assert df.groupBy("ticker").count().where("count > 100").isEmpty()
    assert not df.isEmpty()


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())

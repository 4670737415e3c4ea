import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(spark, duck, SF, name)
    assert ok, note

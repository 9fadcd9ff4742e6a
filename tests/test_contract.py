"""Every registered query against its SQL on the smallest shared tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
STREAMS = [n for n in contract.queries() if n.startswith("stream_")]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["key", "rank", "item_id", "weight", "item_time"]
    assert df.count() > 0


def test_every_statement_has_a_query():
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(SQL) - set(STREAMS)))
def test_matches_sql(spark, duck, name):
    n, problems = compare(spark, duck, SF, contract.queries()[name], SQL[name])
    assert not problems
    assert n > 0


@pytest.mark.parametrize("name", STREAMS)
def test_stream_matches_batch_sql(spark, duck, name):
    n, problems = compare(spark, duck, SF, contract.queries()[name], SQL[name])
    assert not problems
    assert n > 0

"""Registered corpus queries with SQL, next to DuckDB on the smallest tables."""

import pytest

from checks.compare import compare, connect
from footfall.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    n, problems = compare(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLE_SQL[name])
    assert not problems
    assert n > 0


def test_all_are_registered():
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in queries.QUERIES)] == []
    assert "pipeline" in queries.QUERIES

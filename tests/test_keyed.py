"""Bucketed keyed tables: only touched buckets are read and rewritten; upsert, expiry, folding and replay."""

import re

import pytest

from footfall.streaming.keyed import KeyedTable
from footfall.streaming.store import get_alive, put

SCHEMA = "k string, v long"
BUCKETS = 64


def opened(files):
    return {(int(m[1]), int(m[2])) for f in files for m in [re.search(r"batch=(\d+)/bucket=(\d+)/", f)]}


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, f"{tmp_path}/t", SCHEMA, ["k"], BUCKETS)


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def test_lookups_open_touched_buckets_only(spark, table):
    for batch in range(3):
        table.append(rows(spark, *((f"k{i}", batch * 100 + i) for i in range(300))), batch)
    keys = spark.createDataFrame([("k3",), ("k77",)], "k string")
    buckets = table.touched(keys)
    assert 1 <= len(buckets) <= 2
    found = table.lookup(keys, before=2)
    assert sorted((r.k, r.v, r.batch) for r in found.collect()) == [("k3", 3, 0), ("k3", 103, 1), ("k77", 77, 0), ("k77", 177, 1)]
    assert opened(table.read(2, buckets).inputFiles()) == {(b, k) for b in (0, 1) for k in buckets}
    plan = table.read(2, buckets)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan
    assert table.read().count() == 900 and len(opened(table.read().inputFiles())) > 100


def test_folding_rewrites_touched_buckets_only(spark, table):
    table.append(rows(spark, *((f"k{i}", 1) for i in range(300))), 0)
    table.compact(lambda t: t.totals(["k"], "v"))
    table.append(rows(spark, ("k3", 5), ("k4", -1)), 1)
    touched = set(table.touched(spark.createDataFrame([("k3",), ("k4",)], "k string")))
    table.compact(lambda t: t.totals(["k"], "v"), upto=1)
    homes = table._homes(1)
    assert {k for k, b in homes.items() if b == 1} == touched and len(homes) > len(touched)
    got = {r.k: r.v for r in table.totals(["k"], "v").collect()}
    assert got["k3"] == 6 and "k4" not in got and len(got) == 299
    before = {r.k: r.v for r in table.read().collect()}
    table.vacuum()
    assert {r.k: r.v for r in table.read().collect()} == before
    assert {b for b, _ in table._parts("base")} == {0, 1} and not table._parts("log")
    assert all(b == 1 for b, k in table._parts("base") if k in touched)


def test_a_bucket_that_folds_to_nothing_stays_empty(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", SCHEMA, ["k"], 1)
    table.append(rows(spark, ("a", 1)), 0)
    table.compact(lambda t: t.totals(["k"], "v"))
    table.append(rows(spark, ("a", -1)), 1)
    table.compact(lambda t: t.totals(["k"], "v"))
    assert table.read().count() == 0
    table.vacuum()
    assert table.read().count() == 0
    table.append(rows(spark, ("a", 7)), 2)
    assert table.read().select("v").collect() == [(7,)]


def test_replay_and_folding(spark, table):
    table.append(rows(spark, ("a", 1), ("b", 1)), 0)
    table.append(rows(spark, ("a", 9)), 1)
    table.append(rows(spark, ("a", 2)), 1)  # the batch ran again
    table.append(rows(spark, ("a", 4)), 2)
    table.compact(lambda t: t.totals(["k"], "v"), upto=1)
    assert {r.k: r.v for r in table.totals(["k"], "v").collect()} == {"a": 7, "b": 1}
    assert {r.k: r.v for r in table.read(before=2).collect()} == {"a": 3, "b": 1}
    with pytest.raises(ValueError):
        table.read(before=1)
    table.append(rows(spark, ("a", 5)), 2)  # a replay after folding
    assert {r.k: r.v for r in table.totals(["k"], "v").collect()} == {"a": 8, "b": 1}


def test_upsert_and_expiry(spark, tmp_path):
    served = KeyedTable(spark, f"{tmp_path}/s", f"{SCHEMA}, expire_at long", ["k"], BUCKETS)
    put(served, rows(spark, ("a", 1), ("a", 2), ("b", 3)), 0, as_of=100, ttl_seconds=10)
    put(served, rows(spark, ("a", 9)), 1, as_of=105, ttl_seconds=10)
    put(served, rows(spark, ("a", 9)), 1, as_of=105, ttl_seconds=10)
    served.compact(lambda t: t.latest(["k"]), upto=1)
    put(served, rows(spark, ("c", 4)), 2, as_of=106, ttl_seconds=1)
    alive = lambda t: sorted((r.k, r.v) for r in get_alive(served, ["k"], t).collect())
    assert alive(106) == [("a", 9), ("b", 3), ("c", 4)] and alive(110) == [("a", 9)] and alive(115) == []


def test_retracted_tenths_are_gone(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", "k string, weight double", ["k"], 4)
    for batch, w in enumerate((0.1, 0.2, -0.3)):
        table.append(spark.createDataFrame([("a", w), ("b", 0.1)], "k string, weight double"), batch)
    assert [(r.k, r.weight) for r in table.totals(["k"], "weight").collect()] == [("b", 0.3)]

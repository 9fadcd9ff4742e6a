"""Streams against their batch operators: any order, restarts, replays, compaction."""

import os
import random

import pytest
from pyspark.sql import functions as F

from footfall import session
from footfall.model import HISTORY_SCHEMA, Params
from footfall.operators import popularity, similarity
from footfall.streaming import counters, pairs
from footfall.streaming.store import BatchTable, get_alive, put, served_table
from tests.model import START, frame, random_history

P = Params(as_of=START + 10 * 86400)
NOW = {"availableNow": True}
PAIR = ["bid", "item_a", "item_b", "day", "group_id"]


def feed(spark, folder, rows, start):
    """Rows in random order, in two runs of the same job."""
    rows = list(rows)
    random.Random(1).shuffle(rows)
    half = len(rows) // 2
    for part in (rows[:half], rows[half:]):
        frame(spark, part, 2).write.mode("append").parquet(f"{folder}/in")
        start(spark.readStream.schema(HISTORY_SCHEMA).parquet(f"{folder}/in")).awaitTermination()


def test_item_count_in_any_order(spark, tmp_path):
    rows = random_history(11, n=120)
    table = counters.count_table(spark, f"{tmp_path}/counts")
    feed(spark, tmp_path, rows, lambda s: counters.start_item_count(s, table, f"{tmp_path}/cp", P, NOW))
    want = popularity.item_count(frame(spark, rows), P)
    got = table.totals(["bid", "item_id", "day", "group_id"], "weight").select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_item_count_keeps_its_history_in_a_table(spark, tmp_path):
    """No state per key in tasks; folding at every batch and a batch that runs again do not show."""
    rows = random_history(14, n=90)
    random.Random(2).shuffle(rows)
    table, queries = counters.count_table(spark, f"{tmp_path}/counts"), []

    def start():
        source = spark.readStream.schema(HISTORY_SCHEMA).parquet(f"{tmp_path}/in")
        queries.append(counters.start_item_count(source, table, f"{tmp_path}/cp", P, NOW, compact_every=1, buckets=2))
        queries[-1].awaitTermination()

    for part in (rows[:40], rows[40:60], rows[60:]):
        frame(spark, part, 2).write.mode("append").parquet(f"{tmp_path}/in")
        start()
    last = max((int(p.name) for p in (tmp_path / "cp/commits").iterdir() if p.name.isdigit()))
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "cp/commits" / name).unlink(missing_ok=True)
    start()
    assert all(not p["stateOperators"] for q in queries for p in q.recentProgress)
    want = popularity.item_count(frame(spark, rows), P)
    got = table.totals(["bid", "item_id", "day", "group_id"], "weight").select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_pair_count_in_any_order(spark, tmp_path):
    rows = random_history(12, n=120)
    events, table = pairs.history_table(spark, f"{tmp_path}/events"), pairs.pair_table(spark, f"{tmp_path}/pairs")
    feed(spark, tmp_path, rows, lambda s: pairs.start_pair_count(s, events, table, f"{tmp_path}/cp", P, NOW))
    want = similarity.pair_count(frame(spark, rows), P).where("weight <> 0")
    got = table.totals(PAIR, "weight").select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())
    table.compact(lambda t: t.totals(PAIR, "weight"))
    assert sorted(table.totals(PAIR, "weight").select(want.columns).collect()) == sorted(want.collect())
    pairs.expire_history(events, P)
    assert events.read().count() == sum(r[5] >= P.as_of - 9 * 86400 for r in rows)


def test_batch_table(spark, tmp_path):
    table = BatchTable(spark, f"{tmp_path}/t", "k string, v long")
    make = lambda *rows: spark.createDataFrame(list(rows), "k string, v long")
    assert table.read().count() == 0
    table.append(make(("a", 1), ("b", 1)), 0)
    table.append(make(("a", 9)), 1)
    table.append(make(("a", 5), ("a", 6)), 1)  # the batch ran again
    assert sorted(r.v for r in table.latest(["k"]).where("k = 'a'").collect()) == [5, 6]
    assert {r.k: r.v for r in table.totals(["k"], "v").collect()} == {"a": 12, "b": 1}
    assert table.read(before=1).count() == 2
    table.compact(lambda t: t.latest(["k"]))
    table.append(make(("b", 7)), 2)
    assert sorted((r.k, r.v) for r in table.latest(["k"]).collect()) == [("a", 5), ("a", 6), ("b", 7)]


def test_served_table_upsert_and_expiry(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    table = served_table(spark, f"{tmp_path}/served", rows().schema)
    put(table, rows(("a", 1), ("a", 2), ("b", 3)), 0, as_of=100, ttl_seconds=10)
    put(table, rows(("a", 9)), 1, as_of=105, ttl_seconds=10)
    put(table, rows(("a", 9)), 1, as_of=105, ttl_seconds=10)  # repeated
    alive = lambda t: sorted((r.k, r.v) for r in get_alive(table, ["k"], t).collect())
    assert alive(109) == [("a", 9), ("b", 3)]
    assert alive(110) == [("a", 9)]
    assert alive(115) == []


def test_compaction_leaves_the_running_batch_out(spark, tmp_path):
    table = BatchTable(spark, f"{tmp_path}/t", "k string, v long")
    make = lambda *rows: spark.createDataFrame(list(rows), "k string, v long")
    for batch, v in enumerate((1, 2, 4)):
        table.append(make(("a", v)), batch)
    table.compact(lambda t: t.totals(["k"], "v"), upto=1)
    assert table.read(before=2).select("v").collect() == [(3,)]
    assert table.totals(["k"], "v").first()["v"] == 7
    with pytest.raises(ValueError):
        table.read(before=1)
    table.vacuum()
    assert table.totals(["k"], "v").first()["v"] == 7


def test_pairs_after_as_of_and_a_replay_after_compaction(spark, tmp_path):
    """The clock of a running job moves on; a batch that runs again after compaction counts once."""
    rows = random_history(13, n=90)
    old = Params(as_of=min(r[5] for r in rows))
    events, table = pairs.history_table(spark, f"{tmp_path}/events"), pairs.pair_table(spark, f"{tmp_path}/pairs")
    start = lambda s: pairs.start_pair_count(s, events, table, f"{tmp_path}/cp", old, NOW, compact_every=1)
    for part in (rows[:30], rows[30:60], rows[60:]):
        frame(spark, part, 2).write.mode("append").parquet(f"{tmp_path}/in")
        start(spark.readStream.schema(HISTORY_SCHEMA).parquet(f"{tmp_path}/in")).awaitTermination()
    last = max((int(p.name) for p in (tmp_path / "cp/commits").iterdir() if p.name.isdigit()))
    for name in (f"{last}", f".{last}.crc"):  # as if the job had died before the commit
        (tmp_path / "cp/commits" / name).unlink(missing_ok=True)
    start(spark.readStream.schema(HISTORY_SCHEMA).parquet(f"{tmp_path}/in")).awaitTermination()
    want = similarity.pair_count(frame(spark, rows), P).where("weight <> 0")
    got = table.totals(PAIR, "weight").select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_intermediates_of_a_batch_are_deleted(spark, tmp_path):
    made = len(session._made)
    with session.scratch(spark):
        kept = session.materialize(spark.range(3), "probe")
        assert kept.count() == 3 and len(session._made) == made + 1
        path = session._made[-1].removeprefix("file:")
        assert os.path.isdir(path)
    assert not os.path.isdir(path) and len(session._made) == made


def test_weights_that_keys_cannot_hold_are_refused(spark):
    for bad in (0.25, 150.0):
        rows = [r[:-1] + (bad,) if isinstance(r[-1], float) else r for r in random_history(3, n=10)]
        df = frame(spark, rows).withColumn("weight", F.lit(bad))
        with pytest.raises(Exception, match="weight not countable"):
            similarity.pair_count(df, P).collect()

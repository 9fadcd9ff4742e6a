"""Continuous item counts: a table of compact history, a batch table that sums signed changes.

Per (user, item) the history table holds the first time per (day, weight) and the newest trigger. Both only ever shrink or grow
by min/max, so the order in which events arrive does not matter, and late events change the result as they should. A
micro-batch reads the rows of its keys from their buckets and computes, in one pass of built-in expressions, what each key
contributes with and without the batch; the difference goes to the counts.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators import segments as S
from footfall.operators.popularity import by_group
from footfall.streaming.keyed import BUCKETS, KeyedTable
from footfall.streaming.store import BatchTable

KEY = ["bid", "user_id", "group_id", "item_id"]
STATE_SCHEMA = "bid string, user_id string, group_id string, item_id string, day int, tenths int, first_time long, trigger_time long, put_at long"
COUNT_KEY = ["bid", "item_id", "day", "group_id"]
COUNT_SCHEMA = "bid string, item_id string, day long, group_id string, weight double"
NEVER = -1
FOLD_EVERY = 16  # batches, where the job does not say


def compact(history: DataFrame) -> DataFrame:
    """First time and newest trigger per key, day and weight, combined in the tasks that read the history: a user or item with
    a large share of the events sends a few rows per task."""
    trigger = F.when(S.is_trigger(), F.col("action_time")).otherwise(F.lit(NEVER)).cast("long")
    return (
        S.countable(history)
        .groupBy(*KEY, C.epoch_day("action_time").alias("day"), S.tenths().alias("tenths"))
        .agg(F.min("action_time").alias("first_time"), F.max(trigger).alias("trigger_time"))
    )


def _oldest(last: Column, p: Params) -> Column:
    """The newest trigger only moves forward, so days before its link window are never needed again."""
    return C.epoch_day(last - p.link_seconds)


def _ttl_ms(p: Params) -> int:
    return (p.retention_seconds + p.link_seconds) * 1000


def changes(stored: DataFrame, fresh: DataFrame, p: Params, now_ms: int) -> DataFrame:
    """Signed contributions: −1 × the old and +1 × the new one of keys whose best changes. Stored keys that had no event for
    retention and link window (by the clock ``now_ms``) are forgotten."""
    mine = stored.join(fresh.select(*KEY).distinct(), KEY, "left_semi")
    rows = mine.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)))
    key = Window.partitionBy(*KEY)
    old = ~F.col("_new")
    rows = rows.withColumns({"_seen": F.max(F.when(old, F.col("put_at"))).over(key)})
    rows = rows.where(F.col("_new") | (F.col("_seen") > now_ms - _ttl_ms(p)))
    rows = rows.withColumns({"_last": F.max("trigger_time").over(key), "_before": F.max(F.when(old, F.col("trigger_time"))).over(key)})
    seen = lambda last: (F.col("first_time") <= last) & (F.col("day") >= _oldest(last, p))
    bests = rows.groupBy(*KEY).agg(
        F.max(F.when(seen(F.col("_last")), S.pack(F.col("tenths"), F.col("day")))).alias("_after"),
        F.max(F.when(old & seen(F.col("_before")), S.pack(F.col("tenths"), F.col("day")))).alias("_gone"),
    )
    moved = bests.where(~F.col("_after").eqNullSafe(F.col("_gone")))
    signed = F.array(F.struct(F.col("_after").alias("_best"), F.lit(1).alias("_sign")), F.struct(F.col("_gone").alias("_best"), F.lit(-1).alias("_sign")))
    return (
        moved.select(*KEY, F.inline(signed))
        .where(F.col("_best").isNotNull())
        .select(*KEY, S.packed_day(F.col("_best")).alias("day"), (F.col("_sign") * S.packed_tenths(F.col("_best"))).alias("tenths"))
    )


def _folded(rows: DataFrame, p: Params, now_ms: int) -> DataFrame:
    key = Window.partitionBy(*KEY)
    least = rows.groupBy(*KEY, "day", "tenths").agg(
        F.min("first_time").alias("first_time"), F.max("trigger_time").alias("trigger_time"), F.max("put_at").alias("put_at")
    )
    ages = {"_last": F.max("trigger_time").over(key), "put_at": F.max("put_at").over(key)}
    needed = (F.col("_last") == NEVER) | (F.col("day") >= _oldest(F.col("_last"), p))
    return least.withColumns(ages).where(needed & (F.col("put_at") > now_ms - _ttl_ms(p))).drop("_last")


def count_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, COUNT_SCHEMA)


def state_table(table: BatchTable, buckets: int = BUCKETS) -> KeyedTable:
    """The compact history that belongs to a count table, in its folder."""
    return KeyedTable(table.spark, f"{table.path}/state", STATE_SCHEMA, KEY, buckets)


def start_item_count(
    history: DataFrame, table: BatchTable, checkpoint: str, p: Params, trigger: dict | None = None, compact_every: int = 0, buckets: int = BUCKETS
) -> StreamingQuery:
    """Maintain item counts per day and group from a history stream.

    ``trigger`` defaults to the flush interval of the model. With ``compact_every`` the tables are folded every so many
    batches, up to the last committed one; the compact history is folded in any case. ``buckets`` must be the same at every start.
    """
    state = state_table(table, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        now = int(time.time() * 1000)
        table.tidy(lambda t: t.totals(COUNT_KEY, "weight"), batch_id, compact_every)
        state.tidy(lambda t: _folded(t.read(), p, now), batch_id, compact_every or FOLD_EVERY)
        state.append(compact(batch).withColumn("put_at", F.lit(now).cast("long")), batch_id)
        both = state.read_touched(batch_id)
        stored, fresh = (both.where(c).drop("batch") for c in (F.col("batch") < batch_id, F.col("batch") == batch_id))
        rows = changes(stored, fresh, p, now).select(
            "bid", "item_id", "group_id", C.day_of_epoch("day").alias("day"), (F.col("tenths") / 10.0).alias("weight")
        )
        table.append(by_group(rows, ["bid", "item_id", "day"]).where(F.col("weight") != 0), batch_id)

    return (
        history.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{p.flush_seconds} seconds"}))
        .start()
    )

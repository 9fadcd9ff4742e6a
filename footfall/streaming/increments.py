"""Continuous pair increments, the variant without per-user pair contributions.

What an action adds depends on earlier actions of its user alone. So a micro-batch is put to the history of its users inside the
link window, which lies in a table bucketed by user, and the batch operator gives what the batch's actions add.

Events must arrive in order over the micro-batches; inside one any order will do.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall import model as M
from footfall.model import HISTORY_SCHEMA, Params
from footfall.operators import segments as S, similarity
from footfall.session import materialize, scratch
from footfall.streaming.keyed import BUCKETS, KeyedTable
from footfall.streaming.pairs import PAIR_KEY, PAIR_SCHEMA

EVENT_COLUMNS = [f.name for f in HISTORY_SCHEMA.fields]
FOLD_EVERY = 16  # batches, where the job does not say


def pair_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(spark, path, PAIR_SCHEMA, ["bid", "item_a", "item_b"], buckets)


def _reach(time: int, p: Params) -> int:
    """Start of the oldest day that an action at ``time`` looks back to."""
    return (time - p.link_seconds) // M.DAY_SECONDS * M.DAY_SECONDS


def start_pair_increment(
    history: DataFrame, table: KeyedTable, checkpoint: str, p: Params, trigger: dict | None = None, compact_every: int = 0
) -> StreamingQuery:
    """Maintain pair increments per day and group from a history stream that comes in order."""
    events = KeyedTable(table.spark, f"{table.path}/events", HISTORY_SCHEMA, ["bid", "user_id"], table.buckets)

    def fold(rows: DataFrame) -> DataFrame:
        newest = rows.agg(F.max("action_time")).first()[0]
        return rows if newest is None else rows.where(F.col("action_time") >= _reach(newest, p))

    def write(batch: DataFrame, batch_id: int) -> None:
        table.tidy(lambda t: t.totals(PAIR_KEY, "weight"), batch_id, compact_every)
        events.tidy(lambda t: fold(t.read()), batch_id, compact_every or FOLD_EVERY)
        with scratch(table.spark):
            maintain(batch, batch_id)

    def maintain(batch: DataFrame, batch_id: int) -> None:
        fresh = materialize(S.countable(batch).where(F.col("weight") > 0).select(*EVENT_COLUMNS), "batch")
        events.append(fresh, batch_id)
        oldest, newest = fresh.agg(F.min("action_time"), F.max("action_time")).first()
        now = replace(p, as_of=max(p.as_of, newest or 0))
        stored = events.lookup(fresh.select("bid", "user_id").distinct(), batch_id).where(F.col("action_time") >= _reach(oldest or 0, p))
        rows = materialize(stored.select(*EVENT_COLUMNS).unionByName(fresh), "history")
        table.append(similarity.pair_increment(rows, now, fresh=fresh), batch_id)

    return (
        history.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{p.flush_seconds} seconds"}))
        .start()
    )

"""Continuous pair counts.

A micro-batch changes the pair contributions of the users it touches, on days near
its own. Those are computed with and without the batch, by the same skew-safe batch
operator, and the difference goes to the pair table as signed changes. Nothing of a
user is held in one task, and events may arrive in any order.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall import model as M
from footfall.model import HISTORY_SCHEMA, Params
from footfall.operators import segments as S, similarity
from footfall.operators.popularity import by_group
from footfall.session import scratch
from footfall.streaming.store import BatchTable

PAIR_SCHEMA = "bid string, item_a string, item_b string, day long, group_id string, weight double"
PAIR_KEY = ["bid", "item_a", "item_b", "day", "group_id"]
USER = ["bid", "user_id", "group_id"]


def pair_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, PAIR_SCHEMA)


def history_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, HISTORY_SCHEMA)


def pair_changes(stored: DataFrame, batch: DataFrame, p: Params) -> DataFrame:
    """Signed change per user, pair and day that ``batch`` makes to ``stored`` history.

    A contribution that a new event can revoke is dated inside the link window before
    it, and rests on history one more link window back; older rows cancel out.
    """
    users = batch.groupBy(*USER).agg(F.min("action_time").alias("_from"))
    reach = 2 * p.link_seconds + M.DAY_SECONDS
    # Two numbers to the driver, so that the scan of the stored history is cut by time and the
    # clock of a running job moves on: arriving events are never too new to count.
    oldest, newest = batch.agg(F.min("action_time"), F.max("action_time")).first()
    if oldest is None:
        return similarity.user_pair_weight(batch, p)
    latest_stored = stored.agg(F.max("action_time")).first()[0]
    p = replace(p, as_of=max(p.as_of, newest, latest_stored or newest))
    near = stored.where(F.col("action_time") >= oldest - reach - M.DAY_SECONDS).join(users, USER).where(
        F.col("action_time") >= (F.floor((F.col("_from") - reach) / M.DAY_SECONDS) * M.DAY_SECONDS)
    )
    near = near.drop("_from")
    after = similarity.user_pair_weight(near.unionByName(batch), p)
    before = similarity.user_pair_weight(near, p).withColumn("weight", -F.col("weight"))
    return after.unionByName(before)


def start_pair_count(
    history: DataFrame,
    events: BatchTable,
    table: BatchTable,
    checkpoint: str,
    p: Params,
    trigger: dict | None = None,
    compact_every: int = 0,
) -> StreamingQuery:
    """Maintain pair counts per day and group; ``events`` keeps the history needed for it.

    With ``compact_every``, both tables are folded every so many batches, each time up to the
    last committed batch, and history that no later event can reach is left out.
    """
    columns = [f.name for f in HISTORY_SCHEMA.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        table.tidy(lambda t: t.totals(PAIR_KEY, "weight"), batch_id, compact_every)
        events.tidy(lambda t: _reachable(t.read(), p), batch_id, compact_every)
        with scratch(events.spark):
            maintain(batch, batch_id)

    def maintain(batch: DataFrame, batch_id: int) -> None:
        events.append(S.countable(batch).select(*columns), batch_id)
        both = events.read(before=batch_id + 1)
        stored = both.where(F.col("batch") < batch_id).select(*columns)
        fresh = both.where(F.col("batch") == batch_id).select(*columns)
        changed = by_group(pair_changes(stored, fresh, p), ["bid", "item_a", "item_b", "day"])
        table.append(changed.where(F.col("weight") != 0), batch_id)

    return (
        history.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{p.flush_seconds} seconds"}))
        .start()
    )


def _reachable(history: DataFrame, p: Params) -> DataFrame:
    """History that an event no older than the retention window can still reach, by the newest event's clock."""
    newest = history.agg(F.max("action_time")).first()[0]
    clock = max(p.as_of, newest or p.as_of)
    oldest = (clock - p.retention_seconds - 2 * p.link_seconds) // M.DAY_SECONDS * M.DAY_SECONDS
    return history.where(F.col("action_time") >= oldest)


def expire_history(events: BatchTable, p: Params, upto: int | None = None) -> None:
    """Fold the kept history up to a committed batch, without days that no later event can reach."""
    events.compact(lambda t: _reachable(t.read(), p), upto)

"""Continuous detail counts and already-seen lists.

A micro-batch adds its counts per user, day, item and type to a table bucketed by user, which folds them and lets go of
days that the retention window has passed. Lists are made anew for the users of the batch, from their buckets alone, and for
users who lose a day because the clock passed it. The clock is the end of the newest event's day.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators import filtering, history as H
from footfall.session import materialize, scratch
from footfall.streaming.keyed import BUCKETS, KeyedTable
from footfall.streaming.store import BatchTable

USER = ["bid", "user_id"]
COUNT_KEY = ["bid", "user_id", "day", "item_id", "action_type"]
COUNT_SCHEMA = "bid string, user_id string, day long, item_id string, action_type int, cnt long, last_time long"
LIST_SCHEMA = "bid string, user_id string, rank int, item_id string, source string, score double"


@dataclass
class Tables:
    counts: KeyedTable
    lists: KeyedTable
    clock: BatchTable
    late: BatchTable


def tables(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Tables:
    return Tables(
        KeyedTable(spark, f"{path}/counts", COUNT_SCHEMA, USER, buckets),
        KeyedTable(spark, f"{path}/lists", LIST_SCHEMA, USER, buckets),
        BatchTable(spark, f"{path}/clock", "newest long"),
        BatchTable(spark, f"{path}/late", "day long, n long"),
    )


def _day(time: int) -> int:
    return int(datetime.fromtimestamp(time, timezone.utc).strftime("%Y%m%d"))


def _folded(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*COUNT_KEY).agg(F.sum("cnt").alias("cnt"), F.max("last_time").alias("last_time"))


def detail(counts: DataFrame, p: Params) -> DataFrame:
    """Counts of the retention window in the form of ``history.daily_detail``."""
    rows = _folded(counts.where(F.col("day") >= _day(p.as_of - p.retention_seconds)))
    best = F.max(C.action_weight_tenths("action_type")).over(Window.partitionBy(*H.DAY_KEY))
    return rows.withColumns({"counts_as_action": best > 0, "is_impression": C.is_recommend_action("action_type")})


def start_filter_lists(
    history: DataFrame, t: Tables, checkpoint: str, p: Params, trigger: dict | None = None, compact_every: int = 0
) -> StreamingQuery:
    """Maintain detail counts and already-seen lists from a history stream.

    Events older than the retention window are counted per day in ``late`` and left out. With ``compact_every`` the tables
    are folded every so many batches, up to the last committed one.
    """
    windows = (p.retention_days, p.filter_action_days, p.filter_impress_days)

    def tidy(batch_id: int) -> None:
        if not compact_every or not batch_id or batch_id % compact_every:
            return
        clock = t.clock.read(batch_id).agg(F.max("newest")).first()[0] or p.as_of
        day = _day(clock - p.retention_seconds)
        t.clock.tidy(lambda x: x.read().agg(F.max("newest").alias("newest")), batch_id, compact_every)
        t.late.tidy(lambda x: x.read().groupBy("day").agg(F.sum("n").alias("n")), batch_id, compact_every)
        t.counts.tidy(lambda x: _folded(x.read().where(F.col("day") >= day)), batch_id, compact_every)
        t.lists.tidy(lambda x: x.latest(USER).where(F.col("item_id").isNotNull()), batch_id, compact_every)

    def write(batch: DataFrame, batch_id: int) -> None:
        tidy(batch_id)
        with scratch(t.counts.spark):
            maintain(batch, batch_id)

    def maintain(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(H._daily(batch), "batch")
        before = t.clock.read(batch_id).agg(F.max("newest")).first()[0]
        newest = rows.agg(F.max("last_time")).first()[0]
        end = 0 if newest is None else (newest // M.DAY_SECONDS + 1) * M.DAY_SECONDS
        now = max(before or 0, end, p.as_of)
        t.clock.append(t.clock.spark.createDataFrame([(now,)], "newest long"), batch_id)
        oldest = _day(now - p.retention_seconds)
        t.late.append(rows.where(F.col("day") < oldest).groupBy("day").agg(F.sum("cnt").alias("n")), batch_id)
        fresh = rows.where(F.col("day") >= oldest)
        t.counts.append(fresh, batch_id)
        touched = fresh.select(*USER)
        if before is not None and before < now:
            # Users with counts on days that one of the windows held at the last batch and holds no more.
            passed = F.lit(False)
            for days in windows:
                first, last = _day(before - days * M.DAY_SECONDS), _day(now - days * M.DAY_SECONDS)
                passed = passed | ((F.col("day") >= first) & (F.col("day") < last))
            touched = touched.unionByName(t.counts.read(batch_id).where(passed).select(*USER))
        touched = materialize(touched.distinct(), "touched")
        at = replace(p, as_of=now)
        mine = materialize(detail(t.counts.lookup(touched, batch_id + 1), at), "detail")
        lists = filtering.user_filter_list(filtering.filter_scores(mine, at), mine, at)
        lists = materialize(lists.select(*t.lists.schema.names), "lists")
        empty = touched.join(lists.select(*USER).distinct(), USER, "left_anti")
        t.lists.append(lists.unionByName(empty, allowMissingColumns=True), batch_id)

    return (
        history.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{p.flush_seconds} seconds"}))
        .start()
    )


def served(t: Tables) -> DataFrame:
    return t.lists.latest(USER).where(F.col("item_id").isNotNull()).drop("batch")

"""Continuous click-through counters and ranked lists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators import ctr, enrich, ranking
from footfall.streaming.store import BatchTable, stream_settings

CTR_SCHEMA = "bid string, adpos string, page_id string, item_id string, group_id string, day long, impress long, click long"
CTR_KEY = [*ctr.PLACE, "group_id", "day"]
LIST_COLUMNS = "bid string, key string, item_id string, weight double, alg_name string, big_type long, mid_type long, small_type long"
LIST_SCHEMA = LIST_COLUMNS + ", free int, price long, shop_id string, item_time long, update_time long"


def ctr_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, CTR_SCHEMA)


def list_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, LIST_SCHEMA)


def ctr_counts(actions: DataFrame, p: Params) -> DataFrame:
    """Streaming day buckets of impressions and clicks. State of a day is dropped once
    the watermark, one retention window behind the newest event, has passed it."""
    rows = (
        actions.where(C.is_recommend_action("action_type") & C.is_valid_page("item_id"))
        .select(
            "bid",
            "adpos",
            F.col("item_id").alias("page_id"),
            F.explode(C.result_items("action_result")).alias("item_id"),
            "group_id",
            "action_type",
            F.timestamp_seconds("action_time").alias("event_time"),
        )
        .withWatermark("event_time", f"{p.retention_days} days")
    )
    counts = rows.groupBy(*ctr.PLACE, "group_id", F.window("event_time", "1 day").alias("w")).agg(
        F.count_if(F.col("action_type") == M.IMPRESSION_TYPE).alias("impress"),
        F.count_if(F.col("action_type") == M.CLICK_TYPE).alias("click"),
    )
    day = C.day_id(F.unix_seconds(F.col("w.start")))
    return counts.select(*ctr.PLACE, "group_id", day.alias("day"), "impress", "click")


def start_ctr(
    actions: DataFrame,
    table: BatchTable,
    checkpoint: str,
    p: Params,
    trigger: dict | None = None,
    lists: BatchTable | None = None,
    dim_item: DataFrame | None = None,
    clock: Callable[[DataFrame], int] | None = None,
    compact_every: int = 0,
) -> StreamingQuery:
    """Maintain the CTR counters and, when ``lists`` is given, the ranked lists on top.

    ``clock`` gives the evaluation time of a micro-batch from the counters it touched, for retention and
    for the age of items; by default it is the newest day seen, so the lists of a long-running job age.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.tidy(lambda t: t.latest(CTR_KEY), batch_id, compact_every)
        if lists is not None:
            lists.tidy(lambda t: t.latest(["key"]), batch_id, compact_every)
        table.append(batch, batch_id)
        if lists is None:
            return
        touched = table.read(before=batch_id + 1).where(F.col("batch") == batch_id).select(*ctr.PLACE).distinct()
        current = table.latest(CTR_KEY, before=batch_id + 1).join(touched, ctr.PLACE, "left_semi")
        now = replace(p, as_of=(clock or (lambda rows: newest_time(rows, p)))(table.read(before=batch_id + 1)))
        fresh = enrich.enrich_results(ctr.ctr(current, now), dim_item)
        merge_lists(lists, fresh, batch_id, now)

    with stream_settings(table.spark):
        return (
            ctr_counts(actions, p)
            .writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{p.flush_seconds} seconds"}))
            .start()
        )


def newest_time(counters: DataFrame, p: Params) -> int:
    """End of the newest counted day, and never before the job's own start time."""
    day = counters.agg(F.max("day")).first()[0]
    if day is None:
        return p.as_of
    end = datetime.strptime(str(day), "%Y%m%d").replace(tzinfo=timezone.utc) + timedelta(days=1)
    return max(p.as_of, int(end.timestamp()))


def merge_lists(lists: BatchTable, fresh: DataFrame, batch_id: int, p: Params) -> None:
    """Merge new candidates into the stored lists of their keys and store those lists anew."""
    fresh = fresh.withColumn("update_time", F.lit(batch_id).cast("long"))
    columns = [f.name for f in lists.schema.fields]
    keys = fresh.select("key").distinct()
    stored = lists.latest(["key"], before=batch_id).join(keys, "key", "left_semi")
    merged = ranking.top_results(stored.select(*columns).unionByName(fresh.select(*columns)), p)
    lists.append(merged, batch_id)


def served_lists(lists: BatchTable, p: Params) -> DataFrame:
    """Current lists with their ranks."""
    return ranking.top_results(lists.latest(["key"]), p)

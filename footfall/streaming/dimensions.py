"""Continuous dimensions: item messages to validity ranges, by merging the touched keys.

The table is bucketed by key and holds all ranges of a key in one batch's folder. A micro-batch reads the ranges of its keys, puts
its records among them by time and writes those keys anew, so records may arrive in any order. What cannot be parsed or read goes
to ``rejects`` with its reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.session import materialize, scratch
from footfall.sources import dimensions as D, messages as msg
from footfall.streaming.keyed import BUCKETS, KeyedTable
from footfall.streaming.store import BatchTable

KEY = ["bid", "item_id"]
ITEM_SCHEMA = (
    "seq long, bid string, item_id string, imp_date long, big_type long, big_type_name string, mid_type long, mid_type_name string, "
    "small_type long, small_type_name string, free int, publish int, price double, text string, item_time long, plat_form long, "
    "score long, shop_id string, valid_from long, valid_to long"
)
REJECT_SCHEMA = "seq long, line string, reason string"


@dataclass
class Tables:
    items: KeyedTable
    rejects: BatchTable


def tables(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Tables:
    return Tables(KeyedTable(spark, f"{path}/items", ITEM_SCHEMA, KEY, buckets), BatchTable(spark, f"{path}/rejects", REJECT_SCHEMA))


def start_items(messages: DataFrame, t: Tables, checkpoint: str, trigger: dict | None = None, compact_every: int = 0) -> StreamingQuery:
    """Maintain the item dimension from a stream of item messages (seq, attr, line)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        t.items.tidy(lambda x: x.latest(KEY), batch_id, compact_every)
        t.rejects.tidy(lambda x: x.read(), batch_id, compact_every)
        with scratch(t.items.spark):
            maintain(batch, batch_id)

    def maintain(batch: DataFrame, batch_id: int) -> None:
        parsed = materialize(msg.parse_items(batch), "parsed")
        undated = D.day_start("imp_date").isNull()
        reason = F.coalesce("reason", D.fault("item"), F.when(undated, F.lit("bad_imp_date")))
        parsed = parsed.withColumn("reason", reason)
        t.rejects.append(msg.rejected(parsed), batch_id)
        fresh = D.typed_items(msg.accepted(parsed)).withColumn("valid_from", D.day_start("imp_date"))
        fresh = materialize(fresh, "fresh")
        keys = fresh.select(*KEY).distinct()
        stored = t.items.latest(KEY, batch_id, t.items.touched(keys)).join(keys, KEY, "left_semi").drop("batch", "valid_to")
        t.items.append(D.validity(stored.unionByName(fresh), KEY), batch_id)

    return (
        messages.select("seq", "attr", "line")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def ranges(t: Tables) -> DataFrame:
    return t.items.latest(KEY).drop("batch")


def current(t: Tables) -> DataFrame:
    """The record of every key that holds now."""
    return ranges(t).where(F.col("valid_to") == D.FOREVER).drop("valid_from", "valid_to")

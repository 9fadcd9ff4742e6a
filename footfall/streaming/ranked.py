"""Ranked lists kept up to date from changed candidates only.

A list stores its best ``reserve`` entries and a floor: the best entry that was ever left out and may still be
a candidate. New weights replace stored ones; what no change mentions keeps its weight, so the first n entries
stay right as long as they rank before the floor. A list that falls short, because entries lost weight or died, is
built again from all its candidates. Lists are replaced whole; an empty one leaves a row without an item.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators import enrich, ranking
from footfall.session import materialize
from footfall.streaming.keyed import BUCKETS, KeyedTable

OWNER = ["bid", "owner", "alg_name", "group_id"]
LIST_SCHEMA = "bid string, owner string, alg_name string, group_id string, item_id string, weight double, floor_weight double, floor_item string"
_ENTRY = [*OWNER, "item_id", "weight"]


def list_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(spark, path, LIST_SCHEMA, OWNER, buckets)


def _place(weight: str, item: str) -> Column:
    """Compares like the order of a list: smaller comes first."""
    return F.struct((-F.col(weight)).alias("w"), F.col(item).alias("i"))


def _cut(candidates: DataFrame, reserve: int, floors: DataFrame | None = None) -> DataFrame:
    """The best ``reserve`` entries per list with the list's floor, the old one or the best entry left out here."""
    ranked = ranking.top_n(candidates.select(*_ENTRY), OWNER, [F.desc("weight"), F.asc("item_id")], reserve + 1, "_r")
    left_out = ranked.where(F.col("_r") > reserve).select(*OWNER, _place("weight", "item_id").alias("_over"))
    rows = ranked.where(F.col("_r") <= reserve).join(left_out, OWNER, "left")
    rows = rows.withColumn("_old", F.lit(None).cast("struct<w:double,i:string>")) if floors is None else rows.join(floors, OWNER, "left")
    return rows.select(*_ENTRY, F.least("_old", "_over").alias("_floor"))


def merge(
    table: KeyedTable,
    changes: DataFrame,
    batch_id: int,
    n: int,
    reserve: int,
    alive: Callable[[DataFrame], DataFrame],
    everything: Callable[[DataFrame], DataFrame],
) -> None:
    """Apply changed candidates (list columns, item_id, weight; not positive: gone) to their lists.

    ``alive`` drops candidates that no list may hold. ``everything`` gives all candidates of the lists it is handed.
    """
    changes = materialize(changes.select(*_ENTRY), "list-changes")
    owners = changes.select(*OWNER).distinct()
    stored = table.latest(OWNER, batch_id, table.touched(owners)).join(owners, OWNER, "left_semi")
    stored = materialize(stored.select(*table.schema.names), "list-stored")
    floors = stored.where(F.col("floor_item").isNotNull()).groupBy(*OWNER).agg(F.min(_place("floor_weight", "floor_item")).alias("_old"))
    kept = stored.where(F.col("item_id").isNotNull()).join(changes, [*OWNER, "item_id"], "left_anti")
    candidates = kept.select(*_ENTRY).unionByName(changes.where(F.col("weight") > 0))
    lists = materialize(_cut(alive(candidates), reserve, floors), "list-cut")

    before_floor = F.col("_floor").isNull() | (_place("weight", "item_id") < F.col("_floor"))
    safe = lists.groupBy(*OWNER).agg(F.count_if(before_floor).alias("_safe"), F.min("_floor").alias("_floor"))
    safe = floors.join(safe, OWNER, "full").where(F.coalesce("_floor", "_old").isNotNull())
    short = materialize(safe.where(F.coalesce("_safe", F.lit(0)) < n).select(*OWNER), "list-short")
    if not short.isEmpty():
        again = alive(everything(short).where(F.col("weight") > 0))
        lists = lists.join(short, OWNER, "left_anti").unionByName(_cut(again, reserve))
    empty = owners.join(lists.select(*OWNER).distinct(), OWNER, "left_anti")
    rows = lists.select(*_ENTRY, (-F.col("_floor.w")).alias("floor_weight"), F.col("_floor.i").alias("floor_item"))
    table.append(rows.unionByName(empty, allowMissingColumns=True), batch_id)


def still_listed(candidates: DataFrame, dim_item: DataFrame, p: Params) -> DataFrame:
    """Candidates whose item is young enough for its list; unknown items are too old for any."""
    times = dim_item.select("bid", "item_id", "item_time")
    rows = candidates.join(times, ["bid", "item_id"], "left").fillna(0, ["item_time"])
    return ranking.alive(_with_key(rows), p).drop("key", "item_time")


def _with_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", C.result_key("bid", "owner", F.lit(M.DEFAULT_ADPOS), "alg_name", "group_id"))


def served(table: KeyedTable, dim_item: DataFrame, p: Params) -> DataFrame:
    """Current lists with item attributes and ranks, as ``ranking.top_results`` makes them."""
    rows = _with_key(table.latest(OWNER).where(F.col("item_id").isNotNull()))
    rows = enrich.enrich_items(rows.select("bid", "key", "item_id", "weight", "alg_name"), dim_item)
    return ranking.top_results(rows.withColumn("update_time", F.lit(p.as_of).cast("long")), p)

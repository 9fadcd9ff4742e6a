"""Ranked lists. All are ``row_number() <= n`` over a total order, for which Spark
keeps at most n rows per key and input partition before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators.enrich import enrich_items
from footfall.sources.dimensions import latest_per


def top_n(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def alive(candidates: DataFrame, p: Params) -> DataFrame:
    """Positive weight and an item young enough for its list: hot lists live shorter."""
    # The list id is the last part but one of the key; item ids before it may hold "#" themselves.
    ttl = F.when(F.element_at(F.split("key", "#"), -2).contains("3001"), p.hot_item_ttl_seconds).otherwise(p.item_ttl_seconds)
    return candidates.where((F.col("weight") > 0) & (F.lit(p.as_of) - F.col("item_time") <= ttl))


def top_results(candidates: DataFrame, p: Params) -> DataFrame:
    """Final lists: newest record per (key, item), expired items out, best n by weight.

    ``candidates`` need ``key, item_id, weight, item_time, update_time``.
    """
    newest = latest_per(candidates, ["key", "item_id"], [F.desc("update_time"), F.desc("weight")])
    order = [F.desc("weight"), F.desc("update_time"), F.asc("item_id")]
    return top_n(alive(newest, p), ["key"], order, p.result_size)


def nest_results(lists: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per key with the ordered list; bounded by the list size."""
    entry = F.struct("rank", *columns)
    return lists.groupBy("key").agg(F.sort_array(F.collect_list(entry)).alias("results"))


def recent_rows(actions: DataFrame) -> DataFrame:
    """Actions that enter a list of newest items, with the list's key: the user's, or the uid's where the user is
    unknown. Recommend actions are left out. Without ``platform`` or ``lbs_info`` these are null."""
    by_user = C.is_valid_user("user_id")
    by_uid = (F.col("uid") != "") & (F.col("uid") != "0")
    key = F.when(by_user, C.join_key("bid", "user_id", F.lit(M.LIST_RECENT_BY_USER))).when(
        by_uid, C.join_key("bid", "uid", F.lit(M.LIST_RECENT_BY_UID))
    )
    for place in ("platform", "lbs_info"):
        if place not in actions.columns:
            actions = actions.withColumn(place, F.lit(None).cast("string"))
    return (
        actions.where(C.is_valid_item("item_id") & ~C.is_recommend_action("action_type"))
        .select("bid", key.alias("key"), "item_id", "action_type", "action_time", "seq", "platform", "lbs_info")
        .where(F.col("key").isNotNull())
    )


def recent_columns(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "key",
        "rank",
        "item_id",
        "action_type",
        "action_time",
        "seq",
        "platform",
        "lbs_info",
        "big_type",
        "mid_type",
        "small_type",
        "shop_id",
        "item_time",
    )


def user_recent(actions: DataFrame, dim_item: DataFrame, p: Params) -> DataFrame:
    """Newest distinct items per user, or per uid where the user is unknown, with where they were
    acted on and the items' attributes.

    Lists are cut to size first and enriched afterwards, so the lookup join sees at
    most ``recent_size`` rows per user instead of all actions.
    """
    rows = recent_rows(actions).where(F.col("action_time") <= p.as_of)
    newest = latest_per(rows, ["key", "item_id"], [F.desc("action_time"), F.desc("seq")])
    ranked = top_n(newest, ["key"], [F.desc("action_time"), F.desc("seq"), F.asc("item_id")], p.recent_size)
    return recent_columns(enrich_items(ranked, dim_item))


def merge_recent(stored: DataFrame, fresh: DataFrame, p: Params) -> DataFrame:
    """New-over-old merge of two recent lists."""
    rows = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1))).drop("rank")
    newest = latest_per(rows, ["key", "item_id"], [F.desc("_new"), F.desc("action_time"), F.desc("seq")]).drop("_new")
    return top_n(newest, ["key"], [F.desc("action_time"), F.desc("seq"), F.asc("item_id")], p.recent_size)

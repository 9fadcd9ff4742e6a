"""Per-user action history, by day, and the micro-batch combiners."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators.segments import SEQ_BITS

DAY_KEY = ("bid", "user_id", "day", "item_id")
TIME_BITS = 20  # seconds of a flush window


def user_history(actions: DataFrame) -> DataFrame:
    """One row per action and item: both streams, recommended lists exploded.

    A single pass over the actions: recommended lists and single items become one
    array before the explode, instead of a union of two scans. Rows of unknown
    users, empty items or unknown action types drop out (see ``unknown_types``).
    """
    listed = C.is_recommend_action("action_type")
    items = F.when(listed, C.result_items("action_result")).otherwise(F.array("item_id"))
    group = F.col("group_id") if "group_id" in actions.columns else F.lit(M.OVERALL_GROUP)
    return (
        actions.where(C.is_valid_user("user_id") & C.action_weight("action_type").isNotNull())
        .select(
            "bid",
            "user_id",
            group.alias("group_id"),
            F.explode(items).alias("item_id"),
            "action_type",
            "action_time",
            "seq",
            listed.alias("impression"),
            C.action_weight("action_type").alias("weight"),
        )
        .where(C.is_valid_item("item_id"))
    )


def unknown_types(actions: DataFrame) -> DataFrame:
    """Rejects of ``user_history``: action types that have no weight."""
    return actions.where(C.action_weight("action_type").isNull()).withColumn("reason", F.lit("unknown_action_type"))


def explode_impressions(actions: DataFrame) -> DataFrame:
    """Recommend actions, one row per listed item."""
    rows = actions.where(C.is_recommend_action("action_type"))
    return rows.withColumn("item_id", F.explode(C.result_items("action_result")))


def within(rows: DataFrame, as_of: int, days: int, time: str = "action_time") -> DataFrame:
    """Rows of the last ``days`` day buckets at ``as_of``."""
    oldest = (as_of - days * M.DAY_SECONDS) // M.DAY_SECONDS * M.DAY_SECONDS
    return rows.where((F.col(time) >= oldest) & (F.col(time) <= as_of))


def _daily(history: DataFrame) -> DataFrame:
    return (
        history.withColumn("_day", C.epoch_day("action_time"))
        .groupBy("bid", "user_id", "_day", "item_id", "action_type")
        .agg(F.count("*").alias("cnt"), F.max("action_time").alias("last_time"))
        .withColumn("day", C.day_of_epoch("_day"))
        .select("bid", "user_id", "day", "item_id", "action_type", "cnt", "last_time")
    )


def daily_detail(history: DataFrame, p: Params) -> DataFrame:
    """Action and impression detail in one table: count and last time per user, day, item
    and type. ``counts_as_action`` is false for items with only zero-weight actions on
    the day, ``is_impression`` marks the recommend actions."""
    best = F.max(C.action_weight_tenths("action_type")).over(Window.partitionBy(*DAY_KEY))
    daily = _daily(within(history, p.as_of, p.retention_days))
    return daily.withColumns({"counts_as_action": best > 0, "is_impression": C.is_recommend_action("action_type")})


def action_detail(history: DataFrame, p: Params) -> DataFrame:
    """Count and last time per user, day, item and type; items with only zero-weight
    actions on a day are dropped from that day."""
    return daily_detail(history, p).where("counts_as_action").drop("counts_as_action", "is_impression")


def impress_detail(history: DataFrame, p: Params) -> DataFrame:
    """The same for recommend actions alone, without the weight filter."""
    return _daily(within(history.where("impression"), p.as_of, p.retention_days))


def cap_day_items(detail: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` items per user-day, the most recently touched first.

    A list-size feature of the stored history, not a skew guard: the count and pair
    operators read the uncapped history. A type-level row survives when its item does.
    """
    per_item = detail.groupBy(*DAY_KEY).agg(F.max("last_time").alias("_last"))
    order = Window.partitionBy("bid", "user_id", "day").orderBy(F.desc("_last"), "item_id")
    kept = per_item.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit)
    return detail.join(kept.select(*DAY_KEY), list(DAY_KEY), "left_semi")


def nest_detail(detail: DataFrame) -> DataFrame:
    """day → item → type lists per user, newest day first. Use on capped detail."""
    acts = detail.groupBy(*DAY_KEY).agg(
        F.sort_array(F.collect_list(F.struct("action_type", "cnt", "last_time"))).alias("acts")
    )
    days = acts.groupBy("bid", "user_id", "day").agg(
        F.sort_array(F.collect_list(F.struct("item_id", "acts"))).alias("items")
    )
    return days.groupBy("bid", "user_id").agg(
        F.sort_array(F.collect_list(F.struct("day", "items")), asc=False).alias("segments")
    )


def flatten_detail(nested: DataFrame) -> DataFrame:
    """Inverse of ``nest_detail``, with the position of each day in the list."""
    days = nested.select("bid", "user_id", F.posexplode("segments").alias("position", "segment"))
    items = days.select("bid", "user_id", "position", "segment.day", F.explode("segment.items").alias("item"))
    return items.select(
        "bid", "user_id", "position", "day", "item.item_id", F.inline("item.acts")
    )


def combine_last(actions: DataFrame, p: Params) -> DataFrame:
    """Per flush window, user and item: the newest record only."""
    window = (F.floor(F.col("action_time") / p.flush_seconds) * p.flush_seconds).cast("long")
    # (time in the window, seq) as one long aggregates by hashing, where a struct would be sorted.
    fits = F.col("seq").between(0, (1 << SEQ_BITS) - 1)
    place = F.shiftleft(F.col("action_time") - window, SEQ_BITS) + F.col("seq")
    place = F.when(fits, place).otherwise(F.raise_error(F.lit("seq out of range")).cast("long"))
    rows = actions.select("bid", "user_id", "item_id", "action_type", window.alias("window_start"), place.alias("_place"))
    return (
        rows.groupBy("bid", "user_id", "item_id", "window_start")
        .agg(F.max("_place").alias("_last"), F.max_by("action_type", "_place").alias("action_type"))
        .select(
            "bid", "user_id", "item_id", "window_start",
            (F.col("window_start") + F.shiftright("_last", SEQ_BITS)).alias("action_time"),
            F.col("_last").bitwiseAND(F.lit((1 << SEQ_BITS) - 1)).alias("seq"),
            "action_type",
        )
    )


def combine_max_type(actions: DataFrame, p: Params) -> DataFrame:
    """Per flush window, user, group and item: the highest action type and its first time."""
    window = (F.floor(F.col("action_time") / p.flush_seconds) * p.flush_seconds).cast("long")
    latest = F.lit(1 << TIME_BITS) - 1
    order = F.shiftleft(F.col("action_type").cast("long"), TIME_BITS) + latest - (F.col("action_time") - window)
    return (
        actions.groupBy("bid", "user_id", "group_id", "item_id", window.alias("window_start"))
        .agg(F.max(order).alias("_best"))
        .select(
            "bid", "user_id", "group_id", "item_id", "window_start",
            F.shiftright("_best", TIME_BITS).cast("int").alias("action_type"),
            (F.col("window_start") + latest - F.col("_best").bitwiseAND(latest)).alias("action_time"),
        )
    )

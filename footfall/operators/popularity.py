"""Item popularity: best weight per user and item, daily sums, hot lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators import segments as S


def user_item_weight(history: DataFrame, p: Params, days: int | None = None) -> DataFrame:
    """Each user's one contribution per item: the best (weight, day) in the link
    window of the user's last action on it.

    Events collapse to (day, weight) rows first, with map-side combine; the window
    then runs over at most days × weights rows per user and item.
    """
    rows = S.since(S.countable(history), p, days)
    compact = rows.groupBy(
        "bid", "user_id", "group_id", "item_id", C.epoch_day("action_time").alias("_day"), S.tenths().alias("_tenths")
    ).agg(
        F.min("action_time").alias("_first"),
        F.max(F.when(S.is_trigger(), F.col("action_time"))).alias("_trigger"),
    )
    last = F.max("_trigger").over(Window.partitionBy("bid", "user_id", "group_id", "item_id"))
    visible = (F.col("_first") <= F.col("_last")) & (F.col("_day") >= C.epoch_day(F.col("_last") - p.link_seconds))
    best = (
        compact.withColumn("_last", last)
        .where(visible)
        .groupBy("bid", "user_id", "group_id", "item_id")
        .agg(F.max(S.pack(F.col("_tenths"), F.col("_day"))).alias("_best"))
    )
    return best.select(
        "bid",
        "user_id",
        "group_id",
        "item_id",
        C.day_of_epoch(S.packed_day(F.col("_best"))).alias("day"),
        (S.packed_tenths(F.col("_best")) / 10.0).alias("weight"),
    )


def by_group(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of weights per key and group, and over all groups as group "0".

    Weights are multiples of 0.1; their tenths are summed, so the order of rows does not show.
    """
    columns = [F.col(k) for k in keys]
    return (
        rows.groupingSets([[*columns, F.col("group_id")], columns], *columns, F.col("group_id"))
        .agg((F.sum(F.round(F.col("weight") * 10).cast("long")) / 10.0).alias("weight"))
        .withColumn("group_id", F.coalesce("group_id", F.lit(M.OVERALL_GROUP)))
        .select(*keys, "group_id", "weight")
    )


def item_count(history: DataFrame, p: Params, days: int | None = None) -> DataFrame:
    """Popularity per item, day and group."""
    return by_group(user_item_weight(history, p, days), ["bid", "item_id", "day"])


def windowed_total(counts: DataFrame, keys: list[str], p: Params) -> DataFrame:
    """Sum of the day buckets of the retention window at ``as_of``."""
    oldest = C.day_id(F.lit(p.as_of - p.retention_seconds))
    total = F.sum(F.round(F.col("weight") * 10).cast("long")) / 10.0
    return counts.where(F.col("day") >= oldest).groupBy(*keys, "group_id").agg(total.alias("weight"))


def item_total(history: DataFrame, p: Params) -> DataFrame:
    contributions = user_item_weight(history, p, p.retention_days)
    oldest = C.day_id(F.lit(p.as_of - p.retention_seconds))
    return by_group(contributions.where(F.col("day") >= oldest), ["bid", "item_id"])


def hot_items(totals: DataFrame) -> DataFrame:
    """Ranked-list candidates of the hot lists, per group and overall."""
    overall = F.col("group_id") == M.OVERALL_GROUP
    list_id = F.when(overall, M.LIST_HOT_OVERALL).otherwise(M.LIST_HOT)
    return totals.where(F.col("weight") > 0).select(
        "bid",
        C.result_key("bid", F.lit("0"), F.lit(M.DEFAULT_ADPOS), list_id, "group_id").alias("key"),
        "item_id",
        "weight",
        list_id.alias("alg_name"),
    )


CATEGORY_LEVELS = ("big_type", "mid_type", "small_type")


def hot_by_category(totals: DataFrame, dim_item: DataFrame, level: str = "big_type") -> DataFrame:
    """The same per category of the item; items without that category drop out."""
    if level not in CATEGORY_LEVELS:
        raise ValueError(f"level must be one of {CATEGORY_LEVELS}")
    overall = F.col("group_id") == M.OVERALL_GROUP
    list_id = F.when(overall, M.LIST_CATEGORY_HOT_OVERALL).otherwise(M.LIST_CATEGORY_HOT)
    category = dim_item.where(F.col(level) > 0).select("bid", "item_id", F.col(level).alias("_category"))
    return (
        totals.where(F.col("weight") > 0)
        .join(category, ["bid", "item_id"])
        .select(
            "bid",
            C.result_key("bid", "_category", F.lit(M.DEFAULT_ADPOS), list_id, "group_id").alias("key"),
            "item_id",
            "weight",
            list_id.alias("alg_name"),
        )
    )


def action_with_history(history: DataFrame, p: Params) -> DataFrame:
    """Each triggering action with what the user had done to its item inside the link
    window by then: one row per day and action type.

    Days are equi-join keys: a day's row is offered to the days it can be linked from,
    so an action meets at most (link days + 1) × types rows, however long the history.
    """
    daily = (
        history.groupBy("bid", "user_id", "item_id", C.epoch_day("action_time").alias("_past"), "action_type")
        .agg(F.min("action_time").alias("first_time"))
        .withColumn("_day", F.explode(F.sequence(F.col("_past"), F.col("_past") + p.link_days)))
        .withColumnRenamed("action_type", "past_type")
    )
    triggers = history.where(S.is_trigger()).select(
        "bid", "user_id", "item_id", "seq", "action_time", "action_type", C.epoch_day("action_time").alias("_day")
    )
    linked = (F.col("first_time") <= F.col("action_time")) & (
        F.col("_past") >= C.epoch_day(F.col("action_time") - p.link_seconds)
    )
    return (
        triggers.join(daily, ["bid", "user_id", "item_id", "_day"])
        .where(linked)
        .select(
            "bid",
            "user_id",
            "item_id",
            "seq",
            "action_time",
            "action_type",
            C.day_of_epoch("_past").alias("past_day"),
            "past_type",
            C.action_weight("past_type").alias("past_weight"),
        )
    )

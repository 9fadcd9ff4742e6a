"""Click-through rates of recommended items per page and position."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params

PLACE = ["bid", "adpos", "page_id", "item_id"]


def _listed(actions: DataFrame) -> DataFrame:
    """Recommend actions of a valid page, one row per listed item."""
    return actions.where(C.is_recommend_action("action_type") & C.is_valid_page("item_id")).select(
        "bid",
        "adpos",
        F.col("item_id").alias("page_id"),
        F.explode(C.result_items("action_result")).alias("item_id"),
        *[c for c in ("group_id",) if c in actions.columns],
        "action_type",
        "action_time",
    )


def ctr_daily(actions: DataFrame) -> DataFrame:
    """Impressions and clicks per place, item, group and day."""
    return (
        _listed(actions)
        .withColumn("_day", C.epoch_day("action_time"))
        .groupBy(*PLACE, "group_id", "_day")
        .agg(
            F.count_if(F.col("action_type") == M.IMPRESSION_TYPE).alias("impress"),
            F.count_if(F.col("action_type") == M.CLICK_TYPE).alias("click"),
        )
        .select(*PLACE, "group_id", C.day_of_epoch("_day").alias("day"), "impress", "click")
    )


def ctr(daily: DataFrame, p: Params, per_group: bool = False) -> DataFrame:
    """Ranked-list candidates by clicks per impression over the retention window."""
    oldest = C.day_id(F.lit(p.as_of - p.retention_seconds))
    keys = [*PLACE, "group_id"] if per_group else PLACE
    sums = (
        daily.where(F.col("day") >= oldest)
        .groupBy(*keys)
        .agg(F.sum("click").alias("click"), F.sum("impress").alias("impress"))
        .withColumn("weight", C.ctr_weight("click", "impress"))
        .where(F.col("weight") > 0)
    )
    group = F.col("group_id") if per_group else F.lit(M.OVERALL_GROUP)
    return sums.select(
        "bid",
        C.result_key("bid", "page_id", "adpos", F.lit(M.LIST_CTR), group).alias("key"),
        "item_id",
        "weight",
        F.lit(M.LIST_CTR).alias("alg_name"),
    )

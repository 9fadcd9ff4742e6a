"""Already-seen lists: scores of items a user has acted on or been shown."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators.ranking import top_n

ACTION, IMPRESS = "action", "impress"
IMPRESS_MIN_TENTHS = 3


def filter_scores(detail: DataFrame, p: Params, current: DataFrame | None = None) -> DataFrame:
    """Score in tenths per user, item and source, from ``history.daily_detail``.

    A detail row can count as an action, as an impression or as both, over different
    numbers of days; one pass over the detail serves both. ``current`` optionally adds
    the actions of the last flush once per (user, item), for a history that does not
    contain them yet.
    """
    sources = []
    for source, member, days in (
        (ACTION, "counts_as_action", p.filter_action_days),
        (IMPRESS, "is_impression", p.filter_impress_days),
    ):
        recent = F.col("day") >= C.day_id(F.lit(p.as_of - days * 86400))
        sources.append(F.when(F.col(member) & recent, F.lit(source)))
    rows = detail.select(
        "bid",
        "user_id",
        "item_id",
        F.explode(F.array(*sources)).alias("source"),
        C.filter_score_tenths("action_type", "cnt").alias("score_tenths"),
    ).where(F.col("source").isNotNull())
    if current is not None:
        last = (
            current.where(
                C.is_valid_user("user_id")
                & C.is_valid_item("item_id")
                & (F.col("action_time") > p.as_of - p.flush_seconds)
                & (F.col("action_time") <= p.as_of)
            )
            .groupBy("bid", "user_id", "item_id")
            .agg(F.max_by("action_type", F.struct("action_time", "seq")).alias("action_type"))
        )
        rows = rows.unionByName(
            last.select(
                "bid",
                "user_id",
                "item_id",
                F.lit(ACTION).alias("source"),
                C.filter_score_tenths("action_type", F.lit(1)).alias("score_tenths"),
            )
        )
    return rows.groupBy("bid", "user_id", "item_id", "source").agg(F.sum("score_tenths").alias("score_tenths"))


def user_filter_list(scores: DataFrame, detail: DataFrame, p: Params) -> DataFrame:
    """Best action scores first, then impressions of at least 0.3 until the list is full.

    An item can be in both parts. Users without any action detail get no list.
    """
    source_rank = F.when(F.col("source") == ACTION, 0).otherwise(1)
    rows = scores.withColumn("source_rank", source_rank).where(
        (F.col("source") == ACTION) | (F.col("score_tenths") >= IMPRESS_MIN_TENTHS)
    )
    ranked = top_n(
        rows, ["bid", "user_id"], [F.asc("source_rank"), F.desc("score_tenths"), F.asc("item_id")], p.filter_size
    )
    active = detail.where("counts_as_action").select("bid", "user_id").distinct()
    return ranked.join(active, ["bid", "user_id"], "left_semi").select(
        "bid", "user_id", "rank", "item_id", "source", (F.col("score_tenths") / 10.0).alias("score")
    )

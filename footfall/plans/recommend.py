"""End-to-end jobs: resolved actions and dimensions to the served tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators import content, ctr, enrich, filtering, history as H, popularity, ranking, segments as S, similarity
from footfall.session import materialize


def hot_lists(actions: DataFrame, dim_item: DataFrame, p: Params) -> DataFrame:
    """Hot lists per group and overall, enriched and ranked."""
    totals = popularity.item_total(H.user_history(actions), p)
    return _ranked(popularity.hot_items(totals), dim_item, p)


def ranked_lists(actions: DataFrame, dim_item: DataFrame, p: Params, level: str = "big_type") -> DataFrame:
    """All ranked lists: hot, hot by category, item-item and click-through.

    The history feeds three counters, so its part inside the window is written to the
    shared folder once instead of being resolved and exploded for each of them.
    """
    history = materialize(S.since(S.countable(H.user_history(actions)), p, p.retention_days), "history")
    totals = materialize(popularity.item_total(history, p), "totals")
    candidates = (
        popularity.hot_items(totals)
        .unionByName(enrich.category_candidates(totals, level))
        .unionByName(similarity.item_cf(similarity.pair_total(history, p), totals))
        .unionByName(ctr.ctr(ctr.ctr_daily(H.within(actions, p.as_of, p.retention_days)), p))
    )
    return _ranked(candidates, dim_item, p)


def _ranked(candidates: DataFrame, dim_item: DataFrame, p: Params) -> DataFrame:
    enriched = enrich.enrich_results(candidates, dim_item).withColumn("update_time", F.lit(p.as_of).cast("long"))
    return ranking.top_results(enriched, p)


def user_lists(actions: DataFrame, dim_item: DataFrame, p: Params) -> dict[str, DataFrame]:
    """Per-user tables: recent items, already-seen items, interest profile."""
    detail = materialize(H.daily_detail(H.user_history(actions), p), "detail")
    profile = content.user_profile(actions, content.item_tags(dim_item), p, content.default_denied_tags())
    return {
        "user_recent": ranking.user_recent(actions, dim_item, p),
        "user_filter": filtering.user_filter_list(filtering.filter_scores(detail, p), detail, p),
        "user_profile": content.profile_top_tags(profile, p),
    }


def write_history(history: DataFrame, path: str) -> None:
    """History partitioned by day, so that retention windows prune whole folders."""
    history.withColumn("day", C.day_id("action_time")).write.mode("overwrite").partitionBy("day").parquet(path)


def read_history(spark: SparkSession, path: str, p: Params, days: int) -> DataFrame:
    """Stored history that the counters need for the last ``days`` days: whole day folders."""
    oldest = C.day_id(F.lit(p.as_of - (days + p.link_days) * M.DAY_SECONDS))
    return spark.read.parquet(path).where(F.col("day") >= oldest).drop("day")

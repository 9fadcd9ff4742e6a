"""Item attributes onto actions and ranked-list candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall import model as M
from footfall.operators.popularity import CATEGORY_LEVELS

def _attributes(dim_item: DataFrame) -> DataFrame:
    return dim_item.select(
        "bid",
        "item_id",
        "big_type",
        "mid_type",
        "small_type",
        "free",
        F.floor("price").cast("long").alias("price"),
        "shop_id",
        "item_time",
    )


NUMBERS = ["big_type", "mid_type", "small_type", "free", "price", "item_time"]


def enrich_items(rows: DataFrame, dim_item: DataFrame) -> DataFrame:
    """Left join on (bid, item); unknown items get 0 and ""."""
    joined = rows.join(_attributes(dim_item), ["bid", "item_id"], "left")
    return joined.fillna(0, NUMBERS).fillna("", ["shop_id"])


def enrich_items_as_of(rows: DataFrame, ranges: DataFrame, time: str = "action_time") -> DataFrame:
    """The same with the attributes that held at each row's ``time``: ``ranges`` has ``valid_from`` and ``valid_to``.

    An equi-join on (bid, item) with a time range; ranges of an item do not overlap, so no row is repeated. Rows from
    before an item's first record are rows of an unknown item.
    """
    held = ranges.select(
        F.col("bid").alias("_bid"), F.col("item_id").alias("_item"), "valid_from", "valid_to", *_attributes(ranges).columns[2:]
    ).withColumn("price", F.floor("price").cast("long"))
    at = (F.col("bid") == F.col("_bid")) & (F.col("item_id") == F.col("_item"))
    joined = rows.join(held, at & (F.col(time) >= F.col("valid_from")) & (F.col(time) < F.col("valid_to")), "left")
    return joined.drop("_bid", "_item", "valid_from", "valid_to").fillna(0, NUMBERS).fillna("", ["shop_id"])


PLACEHOLDERS = {"big_type": "Big-Type", "mid_type": "Mid-Type", "small_type": "Small-Type"}


def enrich_results(candidates: DataFrame, dim_item: DataFrame) -> DataFrame:
    """The same for candidates; category lists whose key still holds a level name get
    the item's category in its place, or drop out when the item has none."""
    rows = enrich_items(candidates, dim_item)
    is_category = F.col("alg_name").isin(M.LIST_CATEGORY_HOT, M.LIST_CATEGORY_HOT_OVERALL)
    key, keep = F.col("key"), F.lit(True)
    for level in CATEGORY_LEVELS:
        name = PLACEHOLDERS[level]
        here = is_category & F.col("key").contains(f"#{name}#")
        key = F.when(here, F.replace(F.col("key"), F.lit(name), F.col(level).cast("string"))).otherwise(key)
        keep = keep & (~here | (F.col(level) > 0))
    return rows.where(keep).withColumn("key", key)


def category_candidates(totals: DataFrame, level: str = "big_type") -> DataFrame:
    """Hot-by-category candidates before the category is known: the key names the level."""
    overall = F.col("group_id") == M.OVERALL_GROUP
    list_id = F.when(overall, M.LIST_CATEGORY_HOT_OVERALL).otherwise(M.LIST_CATEGORY_HOT)
    key = F.concat_ws("#", "bid", F.lit(PLACEHOLDERS[level]), F.lit(M.DEFAULT_ADPOS), list_id, "group_id")
    return totals.where(F.col("weight") > 0).select("bid", key.alias("key"), "item_id", "weight", list_id.alias("alg_name"))

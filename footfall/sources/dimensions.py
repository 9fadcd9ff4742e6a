"""Dimension tables: typed casts and newest-record-wins upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions import columns as C

DIMENSION_TTL_DAYS = 30


def latest_per(rows: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of every key. Spark limits each input partition to one row per
    key before the shuffle (WindowGroupLimit), so a hot key ships one row per task."""
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def upsert_dimension(rows: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Current state of a keyed dimension out of a log of its records."""
    return latest_per(rows, keys, newest_first)


def merge_dimension(current: DataFrame, changes: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Stored dimension plus a change log (a micro-batch, say), newest record per key."""
    return latest_per(current.unionByName(changes, allowMissingColumns=True), keys, newest_first)


def unexpired(rows: DataFrame, as_of: int, ttl_days: int = DIMENSION_TTL_DAYS, day_column: str = "imp_date") -> DataFrame:
    """Records whose import day is inside the time-to-live at ``as_of``."""
    oldest = C.day_id(F.lit(as_of - ttl_days * 86400))
    return rows.where(F.col(day_column).cast("long") >= oldest)


# ------------------------------------------------------------------ typed records

# Per dimension: (column, field of the parsed row, type, is it required).
_ITEM = (
    ("imp_date", "imp_date", "long", True),
    ("big_type", "cate_id1", "long", True),
    ("mid_type", "cate_id2", "long", True),
    ("small_type", "cate_id3", "long", True),
    ("price", "price", "double", False),
    ("item_time", "item_time", "long", True),
    ("plat_form", "plat_form", "long", False),
    ("score", "score", "long", False),
)
_USER = (("imp_date", "imp_date", "long", True), ("level", "level", "int", False), ("reg_date", "reg_date", "long", False), ("reg_time", "reg_time", "long", False))
_WEIGHT = (("imp_date", "imp_date", "long", True), ("weight", "weight", "double", True))
_CATEGORY = (("imp_date", "imp_date", "long", True), ("father_id", "father_id", "int", False))
NUMBERS = {"item": _ITEM, "user": _USER, "weight": _WEIGHT, "category": _CATEGORY}


def fault(kind: str) -> Column:
    """Why a parsed row cannot become a record: the first number that is unreadable, or is missing and required; else null.

    An optional number may be missing, it is null then. Text that is no number is a fault in any of them.
    """
    out = F.lit(None).cast("string")
    for column, field, type_, required in reversed(NUMBERS[kind]):
        empty = F.coalesce(F.trim(F.col(field)) == "", F.lit(True))
        if required:
            out = F.when(empty, F.lit(f"missing_{column}")).otherwise(out)
        out = F.when(~empty & F.col(field).try_cast(type_).isNull(), F.lit(f"bad_{column}")).otherwise(out)
    return out


def unreadable(parsed: DataFrame, kind: str) -> DataFrame:
    """The parsed rows that the typed form of ``kind`` leaves out, with the ``reason``."""
    return parsed.withColumn("reason", fault(kind)).where(F.col("reason").isNotNull())


def _number(kind: str, column: str) -> Column:
    field, type_ = next((f, t) for c, f, t, _ in NUMBERS[kind] if c == column)
    return F.col(field).try_cast(type_).alias(column)


def typed_items(parsed: DataFrame) -> DataFrame:
    """Parsed item rows to the item dimension; what cannot be read is in ``unreadable``."""
    return parsed.where(fault("item").isNull()).select(
        *[c for c in ("seq",) if c in parsed.columns],
        "bid",
        "item_id",
        _number("item", "imp_date"),
        _number("item", "big_type"),
        F.col("cate_name1").alias("big_type_name"),
        _number("item", "mid_type"),
        F.col("cate_name2").alias("mid_type_name"),
        _number("item", "small_type"),
        F.col("cate_name3").alias("small_type_name"),
        C.flag_number("free").alias("free"),
        C.flag_number("publish").alias("publish"),
        _number("item", "price"),
        "text",
        _number("item", "item_time"),
        _number("item", "plat_form"),
        _number("item", "score"),
        "shop_id",
    )


def typed_users(parsed: DataFrame) -> DataFrame:
    return parsed.where(fault("user").isNull()).select(
        *[c for c in ("seq",) if c in parsed.columns],
        "bid",
        "user_id",
        _number("user", "imp_date"),
        "imei",
        "uid",
        _number("user", "level"),
        _number("user", "reg_date"),
        _number("user", "reg_time"),
    )


def typed_weights(parsed: DataFrame) -> DataFrame:
    return parsed.where(fault("weight").isNull()).select(
        *[c for c in ("seq",) if c in parsed.columns],
        "bid",
        F.col("type_id").alias("action_type"),
        _number("weight", "imp_date"),
        _number("weight", "weight"),
    )


def typed_categories(parsed: DataFrame) -> DataFrame:
    return parsed.where(fault("category").isNull()).select(
        *[c for c in ("seq",) if c in parsed.columns],
        "bid",
        "cate_id",
        _number("category", "imp_date"),
        F.col("cate_name").alias("name"),
        "level",
        _number("category", "father_id"),
    )


# ------------------------------------------------------------------ validity ranges

FOREVER = (1 << 63) - 1


def day_start(day: Column | str) -> Column:
    """Epoch seconds at which a yyyyMMdd number begins, in UTC; null where it is no date."""
    text = (F.col(day) if isinstance(day, str) else day).cast("string")
    return F.unix_date(F.try_to_date(text, "yyyyMMdd")).cast("long") * 86400


def validity(records: DataFrame, keys: Sequence[str], since: str = "valid_from", order: str = "seq") -> DataFrame:
    """Records of a key to ranges: each holds from its time to the next one's (``valid_to``, exclusive).

    Of records with one time the last by ``order`` holds.
    """
    rows = latest_per(records, [*keys, since], [F.desc(order)])
    following = F.lead(since).over(Window.partitionBy(*keys).orderBy(since))
    return rows.withColumn("valid_to", F.coalesce(following, F.lit(FOREVER)))

"""Raw message lines to typed streams.

Input is any DataFrame (batch or streaming) with ``attr`` (``k=v&k=v`` text),
``line`` (the separated payload) and whatever else should travel along, such as
a ``seq`` column that gives the arrival order. Every parser adds ``reason``: null
for an accepted row, else why it was rejected, so accepted rows and rejects are
two filters over one plan and nothing is read twice without need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from footfall import model as M
from footfall.functions import columns as C

DEFAULT_SEPARATOR = r"\|"


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False, **options) -> DataFrame:
    """Messages from files. Kafka and the like work the same way: project their
    header to ``attr``, their value to ``line`` and their offset to ``seq``."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    if fmt != "text":
        return reader.schema(M.MESSAGE_SCHEMA).load(path)
    # Text files carry "attr<TAB>line"; arrival order is not recorded in them.
    parts = F.split("value", "\t", 2)
    return reader.load(path).select(
        F.lit(None).cast("long").alias("seq"), F.get(parts, F.lit(0)).alias("attr"), F.get(parts, F.lit(1)).alias("line")
    )


def with_category(messages: DataFrame) -> DataFrame:
    """Category from the batch attribute's ``iname``; messages without it are skipped."""
    pattern = r"(?:^|&)\s*iname=([^&]*)"
    return messages.withColumn(
        "category", F.when(F.col("attr").rlike(pattern), F.trim(F.regexp_extract("attr", pattern, 1)))
    ).where(F.col("category").isNotNull())


def with_fields(messages: DataFrame, separator: str = DEFAULT_SEPARATOR, only: str | None = None) -> DataFrame:
    """Split the line into ``fields``, trailing empties kept, and count-check it.

    ``only`` says that all rows are of one category.
    The one-element explode is a fence: without it the optimizer pushes the checks of
    the parsers below the split and repeats the split in every one of them.
    """
    needed = F.lit(M.MIN_FIELDS[only]) if only else None
    for category, n in () if only else M.MIN_FIELDS.items():
        test = F.col("category") == category
        needed = F.when(test, n) if needed is None else needed.when(test, n)
    rows = messages.select("*", F.explode(F.array(F.split("line", separator, -1))).alias("fields"))
    return rows.withColumn(
        "split_reason",
        F.when(needed.isNull(), F.lit("unknown_category")).when(F.size("fields") < needed, F.lit("too_few_fields")),
    )


def _at(position: int) -> Column:
    return F.get("fields", F.lit(position))


# Each layout gives the output columns of a category and its own reject reason.
Layout = tuple[list[tuple[str, Column]], Column]


def _accept() -> Column:
    return F.lit(None).cast("string")


def _action_layout(profile: str) -> Layout:
    """``general`` needs a partition key and a plausible time. ``news`` also checks
    type, platform and position, takes the item of result-carrying types from the
    result field and strips the item's marker."""
    user, uid, kind, time = _at(2), _at(4), _at(10), _at(12)
    item, result = _at(6), _at(15)
    key = C.part_key(user, uid)
    bad_time = ~C.is_valid_time(time)
    reject = F.when(key.isNull(), F.lit("no_part_key"))
    if profile == "general":
        reject = reject.when(bad_time, F.lit("bad_time"))
    elif profile == "news":
        item = C.strip_suffix(F.when(kind.isin(*M.NEWS_ITEM_IN_RESULT_TYPES), result).otherwise(item))
        known_type = kind.isin(*M.NEWS_PLAIN_TYPES, *M.NEWS_ITEM_IN_RESULT_TYPES)
        reject = (
            reject.when(~known_type, F.lit("type_not_accepted"))
            .when(~_at(8).isin(*M.NEWS_PLATFORMS), F.lit("bad_platform"))
            .when(~C.is_number(_at(9)), F.lit("bad_adpos"))
            .when(bad_time, F.lit("bad_time"))
            .when(~C.is_recommend_action(kind) & ~C.is_valid_item(item), F.lit("empty_item"))
        )
    else:
        raise ValueError(f"unknown profile {profile!r}")
    return [
        ("part_key", key),
        ("bid", _at(1)),
        ("topic", F.when(C.is_recommend_action(kind), M.STREAM_RECOMMEND).otherwise(M.STREAM_ACTION)),
        ("user_id", user),
        ("uid", uid),
        ("adpos", _at(9)),
        ("action_type", kind.try_cast("int")),
        ("action_time", time.try_cast("long")),
        ("item_id", item),
        ("action_result", result),
        ("imei", _at(5)),
        ("platform", _at(8)),
        ("lbs_info", _at(7)),
    ], reject


def _plain_layout(stream: str, key: int, names: str, positions: Sequence[int], reject: Column) -> Layout:
    columns = [("part_key", _at(key)), ("topic", F.lit(stream)), ("bid", _at(1)), ("imp_date", _at(0))]
    return columns + [(n, _at(i)) for n, i in zip(names.split(), positions, strict=True)], reject


def _item_layout() -> Layout:
    reject = (
        F.when(~C.is_valid_item(_at(2)), F.lit("empty_item"))
        .when(~C.is_number(_at(3)), F.lit("bad_category"))
        .when(_at(6) == "", F.lit("no_category_name"))
    )
    names = (
        "item_id cate_id1 cate_id2 cate_id3 cate_name1 cate_name2 cate_name3 free publish price text "
        "item_time expire_time plat_form score"
    )
    columns, reject = _plain_layout(M.STREAM_ITEM, 2, names, range(2, 17), reject)
    return columns + [("shop_id", F.lit("0"))], reject


def _user_layout() -> Layout:
    reject = F.when(~C.is_valid_user(_at(2)), F.lit("bad_user"))
    return _plain_layout(M.STREAM_USER, 2, "user_id imei uid level reg_date reg_time", (2, 4, 5, 6, 7, 8), reject)


def _layout(category: str, profile: str = "general") -> Layout:
    if category == M.CATEGORY_ACTION:
        return _action_layout(profile)
    if category == M.CATEGORY_ITEM:
        return _item_layout()
    if category == M.CATEGORY_USER:
        return _user_layout()
    if category == M.CATEGORY_WEIGHT:
        return _plain_layout(M.STREAM_WEIGHT, 2, "type_id weight", (2, 3), _accept())
    if category == M.CATEGORY_CATEGORY:
        return _plain_layout(M.STREAM_CATEGORY, 2, "cate_id cate_name level father_id", (2, 3, 4, 5), _accept())
    if category == M.CATEGORY_POOL:
        return _plain_layout(M.STREAM_POOL, 2, "pool_id pool_info recom_items top_items ext", (2, 3, 4, 5, 6), _accept())
    raise ValueError(f"unknown category {category!r}")


def _parse(messages: DataFrame, category: str, separator: str, profile: str = "general") -> DataFrame:
    rows = messages if "category" in messages.columns else with_category(messages)
    rows = with_fields(rows.where(F.col("category") == category), separator, category)
    carried = [c for c in rows.columns if c not in ("attr", "category", "fields", "split_reason")]
    columns, reject = _layout(category, profile)
    return rows.select(
        *carried, *[c.alias(n) for n, c in columns], F.coalesce(F.col("split_reason"), reject).alias("reason")
    )


def parse_actions(messages: DataFrame, profile: str = "general", separator: str = DEFAULT_SEPARATOR) -> DataFrame:
    """User-action lines to action rows, routed by ``topic``."""
    return _parse(messages, M.CATEGORY_ACTION, separator, profile)


def parse_items(messages: DataFrame, separator: str = DEFAULT_SEPARATOR) -> DataFrame:
    return _parse(messages, M.CATEGORY_ITEM, separator)


def parse_users(messages: DataFrame, separator: str = DEFAULT_SEPARATOR) -> DataFrame:
    return _parse(messages, M.CATEGORY_USER, separator)


def parse_weights(messages: DataFrame, separator: str = DEFAULT_SEPARATOR) -> DataFrame:
    return _parse(messages, M.CATEGORY_WEIGHT, separator)


def parse_categories(messages: DataFrame, separator: str = DEFAULT_SEPARATOR) -> DataFrame:
    return _parse(messages, M.CATEGORY_CATEGORY, separator)


def parse_ad_pools(messages: DataFrame, separator: str = DEFAULT_SEPARATOR) -> DataFrame:
    return _parse(messages, M.CATEGORY_POOL, separator)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("reason", "line")


def rejected(parsed: DataFrame) -> DataFrame:
    """Rejects keep the raw text and the reason."""
    keep = [c for c in ("seq", "line", "reason") if c in parsed.columns]
    return parsed.where(F.col("reason").isNotNull()).select(*keep)


def with_verdict(messages: DataFrame, profile: str = "general", separator: str = DEFAULT_SEPARATOR) -> DataFrame:
    """Target stream (``topic``) and ``reason`` of messages of any category, in one pass."""
    rows = with_fields(with_category(messages), separator)
    topic, reason = F, F
    for category in M.MIN_FIELDS:
        columns, reject = _layout(category, profile)
        here = F.col("category") == category
        topic = topic.when(here, dict(columns)["topic"])
        reason = reason.when(here, reject)
    return rows.select(
        *messages.columns, "category", topic.alias("topic"), F.coalesce(F.col("split_reason"), reason).alias("reason")
    )


def rejects(messages: DataFrame, profile: str = "general", separator: str = DEFAULT_SEPARATOR) -> DataFrame:
    """Every message, of any category, that is not emitted on a stream."""
    return rejected(with_verdict(messages, profile, separator))


def ingest_counts(messages: DataFrame, profile: str = "general", separator: str = DEFAULT_SEPARATOR) -> DataFrame:
    """Messages received per category and rows emitted per stream."""
    names = F.array(
        F.struct(F.lit("received").alias("side"), F.col("category").alias("name")),
        F.struct(F.lit("emitted").alias("side"), F.when(F.col("reason").isNull(), F.col("topic")).alias("name")),
    )
    return (
        with_verdict(messages, profile, separator)
        .select(F.inline(names))
        .where(F.col("name").isNotNull())
        .groupBy("side", "name")
        .agg(F.count("*").alias("n"))
    )


def observed(parsed: DataFrame, name: str) -> DataFrame:
    """Attach accepted/rejected counters to a batch or streaming parse as a metric."""
    return parsed.observe(
        name,
        F.count("*").alias("received"),
        F.count_if(F.col("reason").isNull()).alias("emitted"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )

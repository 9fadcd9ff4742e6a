"""Fixed values, record schemas and job parameters shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Wire-format and semantic constants of the data model. They are part of the
# input and output contract (message categories, stream names, list ids, action
# weights), so their values are stated as they are.

CATEGORY_USER = "UserInfo"
CATEGORY_ITEM = "ItemInfo"
CATEGORY_ACTION = "UserActionInfo"
CATEGORY_WEIGHT = "ActionWeightInfo"
CATEGORY_CATEGORY = "ItemCategoryInfo"
CATEGORY_POOL = "AdPool"

STREAM_ACTION = "user_action"
STREAM_RECOMMEND = "recommend_action"
STREAM_USER = "user_detail_info"
STREAM_ITEM = "item_detail_info"
STREAM_CATEGORY = "category_level_info"
STREAM_WEIGHT = "action_weight_info"
STREAM_POOL = "adpool_info"

MIN_FIELDS = {
    CATEGORY_ACTION: 16,
    CATEGORY_ITEM: 17,
    CATEGORY_USER: 9,
    CATEGORY_WEIGHT: 4,
    CATEGORY_CATEGORY: 6,
    CATEGORY_POOL: 7,
}

LIST_RECENT_BY_USER = "D1"
LIST_RECENT_BY_UID = "D2"
LIST_CTR = "A1001"
LIST_CF = "C1001"
LIST_CF_OVERALL = "B1001"
LIST_CATEGORY_HOT = "C2001"
LIST_CATEGORY_HOT_OVERALL = "B2001"
LIST_HOT = "C3001"
LIST_HOT_OVERALL = "B3001"

OVERALL_GROUP = "0"
DEFAULT_ADPOS = "1"

RECOMMEND_TYPES = (1, 2)
IMPRESSION_TYPE = 1
CLICK_TYPE = 2

NEWS_PLAIN_TYPES = ("1", "5", "9", "10", "11", "13", "25", "26")
NEWS_ITEM_IN_RESULT_TYPES = ("16", "17", "18")
NEWS_PLATFORMS = ("2", "3")

VALID_GROUPS = (10, 11, 12, 21, 22, 31, 32, 41, 42, 51, 52, 61, 62, 71, 72, 81, 82, 91, 92)

ACTION_WEIGHTS = {
    1: 0.0,
    2: 1.0,
    3: 1.0,
    4: 1.5,
    5: 2.0,
    6: 2.0,
    7: 2.0,
    8: 2.0,
    9: 2.0,
    10: 2.0,
    11: 2.0,
    12: 2.5,
    13: 2.5,
    16: 1.5,
    17: 1.5,
    18: 1.5,
    25: 2.0,
    26: 2.0,
}

PROFILE_WEIGHTS = {
    1: 0.0,
    5: 1.5,
    9: 0.4,
    10: 0.4,
    11: 0.4,
    13: 0.5,
    16: 0.3,
    17: 0.3,
    18: 0.3,
    19: 2.0,
    20: 2.0,
    21: 0.3,
    22: 0.0,
    23: 0.0,
    24: 0.0,
    25: 0.3,
    26: 0.0,
}

PROFILE_LEVEL = 1.0
PROFILE_LOSS = 0.25

DEFAULT_DENIED_TAGS = (
    "新闻",
    "要闻",
    "订阅",
    "图片",
    "视频",
    "精选",
    "北京",
    "上海",
    "广州",
    "深圳",
    "重庆",
    "天津",
    "香港",
    "澳门",
    "山东",
    "山西",
    "河南",
    "河北",
    "湖南",
    "湖北",
    "广东",
    "广西",
    "黑龙江",
    "辽宁",
    "浙江",
    "安徽",
    "江苏",
    "福建",
    "甘肃",
    "江西",
    "云南",
    "贵州",
    "四川",
    "青海",
    "陕西",
    "吉林",
    "宁夏",
    "海南",
    "西藏",
    "内蒙古",
    "新疆",
    "台湾",
)

DAY_SECONDS = 86400

# ------------------------------------------------------------------ parameters


@dataclass(frozen=True)
class Params:
    """Evaluation time (epoch seconds) and tunables, with the defaults of the data model."""

    as_of: int
    retention_days: int = 7
    link_seconds: int = DAY_SECONDS
    result_size: int = 100
    recent_size: int = 30
    filter_size: int = 100
    profile_size: int = 10
    tag_index_size: int = 100
    detail_items_per_day: int = 100
    filter_action_days: int = 3
    filter_impress_days: int = 1
    item_ttl_seconds: int = 6 * 3600
    hot_item_ttl_seconds: int = 3600
    recent_ttl_days: int = 7
    profile_ttl_days: int = 30
    flush_seconds: int = 5
    # Rows of one join key that a single task should see before the key is split.
    rows_per_split: int = 1_000_000

    @property
    def retention_seconds(self) -> int:
        return self.retention_days * DAY_SECONDS

    @property
    def link_days(self) -> int:
        """Whole days a link window can reach back."""
        return -(-self.link_seconds // DAY_SECONDS)


# --------------------------------------------------------------------- schemas

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("attr", T.StringType()),
        T.StructField("line", T.StringType()),
    ]
)

ACTION_COLUMNS = (
    "part_key",
    "bid",
    "topic",
    "user_id",
    "uid",
    "adpos",
    "action_type",
    "action_time",
    "item_id",
    "action_result",
    "imei",
    "platform",
    "lbs_info",
)

ACTION_SCHEMA = T.StructType(
    [T.StructField("seq", T.LongType())]
    + [
        T.StructField(
            name,
            {"action_type": T.IntegerType(), "action_time": T.LongType()}.get(name, T.StringType()),
        )
        for name in ACTION_COLUMNS
    ]
)

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("bid", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("group_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("action_type", T.IntegerType()),
        T.StructField("action_time", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("impression", T.BooleanType()),
        T.StructField("weight", T.DoubleType()),
    ]
)

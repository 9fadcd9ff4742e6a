"""The model's input tables derived from the shared benchmark tables.

``events`` become raw action messages and resolved actions, ``part`` items,
``customer`` users with their uid and group maps, ``orders`` weight messages,
``supplier`` ad pools. See FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from footfall import model as M
from footfall.operators import history as H, identity
from footfall.session import configure
from footfall.sources import messages as msg

AS_OF = 1706659200  # 2024-01-31 00:00:00 UTC
PARAMS = M.Params(as_of=AS_OF)
BUSINESS = "1"
ACTION_TYPES = {"view": 1, "click": 2, "signup": 5, "purchase": 12, "error": 16}
GROUP_CODES = {"AUTOMOBILE": 11, "BUILDING": 21, "FURNITURE": 31, "HOUSEHOLD": 41, "MACHINERY": 99}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _case(column: str, table: dict[str, int]) -> Column:
    case = None
    for name, value in table.items():
        test = F.col(column) == name
        case = F.when(test, F.lit(value)) if case is None else case.when(test, F.lit(value))
    return case


def action_columns(events: DataFrame) -> DataFrame:
    """One action per event, in the shape the parsers emit."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    listed = F.col("event_type").isin("view", "click")
    item = F.concat(F.lit("i"), _text(k))
    other = F.concat(F.lit("i"), _text((k + 7) % 100))
    rows = events.select(
        F.col("event_id").alias("seq"),
        F.date_format("ts", "yyyyMMdd").alias("imp_date"),
        F.lit(BUSINESS).alias("bid"),
        F.when(F.col("user_id") % 10 == 0, "0").otherwise(_text(F.col("user_id") + 10000)).alias("user_id"),
        F.when(F.col("user_id") % 50 == 40, "").otherwise(_text(F.col("user_id") + 1)).alias("uid"),
        _text(F.col("event_id") % 3).alias("adpos"),
        _case("event_type", ACTION_TYPES).alias("action_type"),
        F.unix_timestamp("ts").alias("action_time"),
        F.when(listed, F.concat(F.lit("p"), _text(F.col("event_id") % 5))).otherwise(item).alias("item_id"),
        F.when(listed, F.concat(item, F.lit("#1;"), other, F.lit("#2;"))).otherwise(item).alias("action_result"),
        F.concat(F.lit("m"), _text("user_id")).alias("imei"),
        _text(F.col("event_id") % 4).alias("platform"),
        F.concat(F.lit("l"), _text(F.col("user_id") % 7)).alias("lbs_info"),
    )
    topic = F.when(F.col("action_type").isin(1, 2), M.STREAM_RECOMMEND).otherwise(M.STREAM_ACTION)
    return rows.withColumn("topic", topic)


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return action_columns(table(spark, sf_dir, "events"))


def action_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines, some of them cut short, with a zero time or without a category."""
    return message_lines(actions(spark, sf_dir))


def message_lines(rows: DataFrame) -> DataFrame:
    time = F.when(F.col("seq") % 89 == 0, "0").otherwise(_text("action_time"))
    head = [F.col("imp_date"), F.col("bid"), F.col("user_id"), F.lit(""), F.col("uid"), F.col("imei"), F.col("item_id")]
    head += [F.col("lbs_info"), F.col("platform"), F.col("adpos"), _text("action_type"), F.lit("")]
    tail = [time, F.lit(""), F.lit(""), F.col("action_result")]
    line = F.when(F.col("seq") % 97 == 0, F.concat_ws("|", *head)).otherwise(F.concat_ws("|", *head, *tail))
    attr = (
        F.when(F.col("seq") % 101 == 0, "m=0&t=1")
        .when(F.col("seq") % 103 == 0, "m=0&iname=Unknown")
        .otherwise(f"m=0& iname={M.CATEGORY_ACTION}")
    )
    return rows.select("seq", attr.alias("attr"), line.alias("line"))


def uid_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _text(key + 1).alias("uid"), F.when(key % 20 == 0, "0").otherwise(_text(key + 10000)).alias("user_id")
    )


def group_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = _text(_case("c_mktsegment", GROUP_CODES))
    return table(spark, sf_dir, "customer").select(
        _text(F.col("c_custkey") + 10000).alias("user_id"), F.concat(F.lit("g,"), code, F.lit("|x")).alias("value")
    )


def resolved_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.resolve_identity(actions(spark, sf_dir), uid_map(spark, sf_dir), group_map(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.user_history(resolved_actions(spark, sf_dir))


# ------------------------------------------------------------------ dimensions


def _message(category: str, *parts: Column) -> list[Column]:
    return [F.lit(f"iname={category}").alias("attr"), F.concat_ws("|", *[_text(p) for p in parts]).alias("line")]


def item_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two item lines per part (an older and a newer record), some of them invalid."""
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").withColumn("version", F.explode(F.array(F.lit(0), F.lit(1))))
    price = (F.col("p_retailprice") + F.col("version")).cast("decimal(14,2)")
    return rows.select(
        (key * 2 + F.col("version")).alias("seq"),
        *_message(
            M.CATEGORY_ITEM,
            F.col("version") + 20240129,
            F.lit(BUSINESS),
            F.when(key % 41 == 7, "").otherwise(F.concat(F.lit("i"), _text(key))),
            F.when(key % 37 == 5, "x").otherwise(_text(F.ascii("p_type"))),
            F.regexp_extract("p_brand", r"(\d+)", 1),
            F.col("p_size"),
            F.when(key % 43 == 9, "").otherwise(F.col("p_type")),
            F.col("p_brand"),
            F.element_at(F.split("p_name", " "), 1),
            key % 3,
            F.lit(1),
            price,
            F.col("p_name"),
            F.lit(AS_OF) - (key % 16) * 1800,
            F.lit(AS_OF + 86400),
            key % 4,
            key % 100,
        ),
    )


def user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("seq"),
        *_message(
            M.CATEGORY_USER,
            F.lit(20240130),
            F.lit(BUSINESS),
            F.when(key % 20 == 0, "0").otherwise(_text(key + 10000)),
            F.lit(""),
            F.concat(F.lit("m"), _text(key)),
            key + 1,
            F.col("c_nationkey") % 5,
            F.lit(20230101) + key % 28,
            F.lit(1672531200) + key * 60,
        ),
    )


def weight_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weight record per order: the newest one per action type wins."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        *_message(
            M.CATEGORY_WEIGHT,
            F.date_format("o_orderdate", "yyyyMMdd"),
            F.lit(BUSINESS),
            F.col("o_custkey") % 200,
            F.concat(_text((F.col("o_orderkey") % 4)), F.lit(".5")),
        ),
    )


def category_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per part for its brand, father = its type."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seq"),
        *_message(
            M.CATEGORY_CATEGORY,
            F.lit(20240101) + F.col("p_partkey") % 28,
            F.lit(BUSINESS),
            F.regexp_extract("p_brand", r"(\d+)", 1),
            F.col("p_brand"),
            F.lit(2),
            F.ascii("p_type"),
        ),
    )


def pool_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("seq"),
        *_message(
            M.CATEGORY_POOL,
            F.lit(20240130),
            F.lit(BUSINESS),
            key,
            F.col("s_name"),
            F.concat(F.lit("i"), _text(key), F.lit(";i"), _text(key + 1)),
            F.concat(F.lit("i"), _text(key + 2)),
            F.lit("e"),
        ),
    )


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [action_messages, item_messages, user_messages, weight_messages, category_messages, pool_messages]
    out = None
    for part in parts:
        rows = part(spark, sf_dir).select("seq", "attr", "line")
        out = rows if out is None else out.unionByName(rows)
    return out


def dim_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed items, all of them; every 25th goes by another id, so that lookups can miss."""
    key = F.col("p_partkey")
    letter = F.when(key % 25 == 24, "u").otherwise("i")
    return (
        table(spark, sf_dir, "part")
        .select(
            F.lit(BUSINESS).alias("bid"),
            F.concat(letter, _text(key)).alias("item_id"),
            F.ascii("p_type").cast("long").alias("big_type"),
            F.col("p_type").alias("big_type_name"),
            F.regexp_extract("p_brand", r"(\d+)", 1).cast("long").alias("mid_type"),
            F.col("p_brand").alias("mid_type_name"),
            F.col("p_size").cast("long").alias("small_type"),
            F.element_at(F.split("p_name", " "), 1).alias("small_type_name"),
            (key % 3).cast("int").alias("free"),
            F.col("p_retailprice").alias("price"),
            F.concat(F.lit("s"), _text(key % 10)).alias("shop_id"),
            (F.lit(AS_OF) - (key % 16) * 1800).cast("long").alias("item_time"),
            F.col("p_name").alias("text"),
        )
    )


def dim_item_messages_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.accepted(msg.parse_items(item_messages(spark, sf_dir)))

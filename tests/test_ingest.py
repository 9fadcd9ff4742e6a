"""Hand-made messages for the parsers, the rules and the dimension upserts."""

import pytest
from pyspark.sql import functions as F

from footfall.functions import columns as C
from footfall.operators import history as H, identity
from footfall.sources import dimensions as D, messages as msg, rules


def action_line(**kw):
    v = dict(bid="1", user="12345", uid="77", imei="m", item="i1", lbs="l", platform="2", adpos="1", type="5", time="1706600000", result="r")
    v.update(kw)
    fields = ["20240130", v["bid"], v["user"], "", v["uid"], v["imei"], v["item"], v["lbs"], v["platform"], v["adpos"], v["type"], ""]
    return "|".join([*fields, v["time"], "", "", v["result"]])


def messages(spark, lines, attr="iname=UserActionInfo"):
    return spark.createDataFrame([(i, attr, line) for i, line in enumerate(lines)], "seq long, attr string, line string")


def verdicts(spark, lines, profile):
    rows = msg.parse_actions(messages(spark, lines), profile).orderBy("seq").collect()
    return [r.reason for r in rows]


def test_general_profile(spark):
    lines = [
        action_line(),
        action_line(user="1234", uid="9"),
        action_line(user="0", uid=""),
        action_line(time="0"),
        action_line(time="12345678"),
        "a|b|c",
        action_line(type="abc"),
    ]
    assert verdicts(spark, lines, "general") == [None, None, "no_part_key", "bad_time", "bad_time", "too_few_fields", None]


def test_news_profile(spark):
    lines = [
        action_line(item="i1#1"),
        action_line(type="16", result="i9#2"),
        action_line(type="16", result=""),
        action_line(type="2"),
        action_line(platform="1"),
        action_line(adpos="x"),
        action_line(type="1", item=""),
        action_line(time="1"),
    ]
    reasons = [None, None, "empty_item", "type_not_accepted", "bad_platform", "bad_adpos", None, "bad_time"]
    assert verdicts(spark, lines, "news") == reasons
    rows = msg.accepted(msg.parse_actions(messages(spark, lines), "news")).orderBy("seq").collect()
    assert [(r.item_id, r.topic) for r in rows] == [("i1", "user_action"), ("i9", "user_action"), ("", "recommend_action")]


def test_category_attribute(spark):
    attrs = ["iname=A", "m=0& iname=B &t=1", "m=0", "xiname=C", None]
    rows = spark.createDataFrame([(i, a, "") for i, a in enumerate(attrs)], "seq long, attr string, line string")
    assert [(r.seq, r.category) for r in msg.with_category(rows).orderBy("seq").collect()] == [(0, "A"), (1, "B")]


def test_trailing_empty_fields_count_and_separator_is_configurable(spark):
    line = action_line(result="").replace("|", ",")
    rows = msg.parse_actions(messages(spark, [line]), separator=",").collect()
    assert rows[0].reason is None and rows[0].action_result == ""


def test_rejects_keep_the_text(spark):
    bad = messages(spark, ["a|b"]).unionByName(messages(spark, ["x|y"], "iname=Other")).unionByName(messages(spark, ["z"], "m=1"))
    got = {(r.line, r.reason) for r in msg.rejects(bad).collect()}
    assert got == {("a|b", "too_few_fields"), ("x|y", "unknown_category")}


def test_ad_pools_have_their_own_stream(spark):
    counts = msg.ingest_counts(messages(spark, ["20240101|1|p|info|a;b|c|e"], "iname=AdPool")).collect()
    assert {(r.side, r.name, r.n) for r in counts} == {("received", "AdPool", 1), ("emitted", "adpool_info", 1)}


def test_reading_text_files(spark, tmp_path):
    (tmp_path / "m.txt").write_text("iname=UserActionInfo\t" + action_line() + "\n")
    got = msg.accepted(msg.parse_actions(msg.read_messages(spark, str(tmp_path), "text"))).first()
    assert (got.user_id, got.action_type, got.action_time) == ("12345", 5, 1706600000)


def test_observed_metrics(spark):
    from pyspark.sql import Observation

    # A session of its own: one that has seen an Observation can no longer fit ML models.
    seen = Observation("ingest")
    parsed = msg.parse_actions(messages(spark.newSession(), [action_line(), "x"]))
    parsed.observe(seen, F.count("*").alias("n")).count()
    assert seen.get["n"] == 2
    assert msg.observed(parsed, "m").count() == 2


def test_rules(spark):
    config = rules.TopicRules(
        fields={"t": ("a", "b")},
        rules={("1", "t"): {"a": rules.ColumnRule(not_null=True), "b": rules.ColumnRule(value_range="[5,9]")}},
    )
    data = [
        ("1", "t", ["x", "5"]),
        ("1", "t", ["NULL", "5"]),
        ("1", "t", [None, "5"]),
        ("1", "t", ["x", "4"]),
        ("1", "t", ["x", "1.5"]),
        ("1", "t", ["x", "99999999999999999999"]),
        ("1", "t", ["x"]),
        ("2", "t", ["x", "5"]),
        ("1", "u", ["x", "5"]),
    ]
    rows = spark.createDataFrame(data, "bid string, topic string, values array<string>").coalesce(1)
    checked = rules.validate_rows(rows, config)
    assert [r.reason for r in checked.collect()] == [
        None, "bad_a", "bad_a", "bad_b", "bad_b", "bad_b", "field_count", "unknown_topic", "unknown_topic",
    ]
    assert rules.named_values(checked, config).first().row == {"a": "x", "b": "5"}
    assert rules.ColumnRule(value_range="[a,9]").bounds() is None


def test_dimension_merge_keeps_the_newest(spark):
    old = spark.createDataFrame([("k", 1, "a"), ("l", 5, "b")], "key string, v long, x string")
    new = spark.createDataFrame([("k", 2, "c"), ("l", 4, "d")], "key string, v long, x string")
    got = D.merge_dimension(old, new, ["key"], [F.desc("v")])
    assert {(r.key, r.x) for r in got.collect()} == {("k", "c"), ("l", "b")}


def test_dimension_expiry(spark):
    rows = spark.createDataFrame([(20240101,), (20231231,)], "imp_date long")
    assert [r.imp_date for r in D.unexpired(rows, 1706659200, ttl_days=30).collect()] == [20240101]


def test_identity(spark):
    actions = spark.createDataFrame(
        [("12345", "", 1), ("0", "7", 1), ("0", "8", 1), ("0", "9", 1), ("0", "0", 1), ("0", "", 1)],
        "user_id string, uid string, action_time long",
    )
    uids = spark.createDataFrame([("7", "55555"), ("8", "0")], "uid string, user_id string")
    groups = spark.createDataFrame([("12345", "g|21|x"), ("55555", "g,99")], "user_id string, value string")
    got = identity.resolve_identity(actions, uids, groups).collect()
    assert sorted((r.uid, r.user_id, r.group_id) for r in got) == [
        ("", "12345", "21"), ("7", "55555", "0"), ("8", "0", "0"), ("9", "0", "0"),
    ]


def test_history_quirks(spark):
    schema = "bid string, user_id string, group_id string, item_id string, action_type int, action_time long, action_result string, seq long"
    rows = [
        ("1", "12345", "11", "page", 1, 1706600000, "a#1;b#2;;c#3;", 1),
        ("1", "12345", "11", "x", 99, 1706600000, "", 2),
        ("1", "12345", "11", "", 5, 1706600000, "", 3),
        ("1", "1", "11", "x", 5, 1706600000, "", 4),
        ("1", "12345", "11", "y#1", 5, 1706600000, "", 5),
    ]
    actions = spark.createDataFrame(rows, schema)
    got = H.user_history(actions).collect()
    assert sorted((r.item_id, r.impression) for r in got) == [("a", True), ("b", True), ("c#3", True), ("y#1", False)]
    assert [r.seq for r in H.unknown_types(actions).collect()] == [2]


@pytest.mark.parametrize(
    ("value", "want"), [("a,21", "21"), ("a|22,b", "22"), ("a", "0"), ("a,23", "0"), ("a,", "0"), ("a,011", "011"), ("", "0")]
)
def test_parse_group(spark, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(C.parse_group("v")).first()[0] == want


def test_days_and_validity(spark):
    rows = spark.createDataFrame([(0,), (86399,), (86400,), (1709164800,)], "t long")
    assert [r[0] for r in rows.select(C.day_id("t")).collect()] == [19700101, 19700101, 19700102, 20240229]
    users = spark.createDataFrame([("12345",), ("1234",), ("0",), ("12345\n",), (None,), ("1234x",)], "u string")
    assert [r[0] for r in users.select(C.is_valid_user("u")).collect()] == [True, False, False, False, False, False]

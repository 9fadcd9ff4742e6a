"""Ranked lists, filter lists, tags and profiles on hand fixtures."""

from dataclasses import replace

from pyspark.sql import functions as F

from footfall.model import Params
from footfall.operators import content, ctr, enrich, filtering, history as H, ranking

NOW = 1706659200
P = Params(as_of=NOW, result_size=2, recent_size=2, filter_size=3, profile_size=2, tag_index_size=2)


def lists(spark, rows):
    return spark.createDataFrame(rows, "key string, item_id string, weight double, item_time long, update_time long")


def test_top_results(spark):
    rows = [
        ("1#0#1#C3001#11", "old", 9.0, NOW - 3601, 1),
        ("1#0#1#C3001#11", "a", 1.0, NOW - 3600, 1),
        ("1#0#1#C3001#11", "a", 3.0, NOW - 10, 2),
        ("1#0#1#C3001#11", "b", 3.0, NOW - 10, 3),
        ("1#0#1#C3001#11", "c", 3.0, NOW - 10, 2),
        ("1#x#1#C1001#11", "p", 1.0, NOW - 21600, 1),
        ("1#x#1#C1001#11", "q", 1.0, NOW - 21601, 1),
        ("1#x#1#C1001#11", "r", 0.0, NOW, 1),
        ("1#x#1#C1001#11", "unknown", 1.0, 0, 1),
    ]
    got = ranking.top_results(lists(spark, rows), P).collect()
    assert sorted((r.key, r["rank"], r.item_id, r.weight) for r in got) == [
        ("1#0#1#C3001#11", 1, "b", 3.0), ("1#0#1#C3001#11", 2, "a", 3.0), ("1#x#1#C1001#11", 1, "p", 1.0),
    ]
    nested = ranking.nest_results(ranking.top_results(lists(spark, rows), P), ["item_id"]).where("key like '%3001%'").first()
    assert [e.item_id for e in nested.results] == ["b", "a"]


def test_enrich_results_rewrites_category_keys(spark):
    schema = "bid string, item_id string, big_type long, mid_type long, small_type long, free int, price double, shop_id string, item_time long"
    dim = spark.createDataFrame([("1", "a", 5, 0, 7, 1, 9.9, "s", 10)], schema)
    rows = [("1", f"1#{t}#1#C2001#11", i, 1.0, "C2001") for t in ("Big-Type", "Mid-Type", "Small-Type") for i in ("a", "zz")]
    candidates = spark.createDataFrame(rows + [("1", "1#0#1#C3001#11", "zz", 1.0, "C3001")], "bid string, key string, item_id string, weight double, alg_name string")
    got = sorted((r.key, r.item_id, r.price, r.shop_id) for r in enrich.enrich_results(candidates, dim).collect())
    assert got == [("1#0#1#C3001#11", "zz", 0, ""), ("1#5#1#C2001#11", "a", 9, "s"), ("1#7#1#C2001#11", "a", 9, "s")]


def detail(spark, rows):
    schema = "bid string, user_id string, group_id string, item_id string, action_type int, action_time long, seq long, impression boolean, weight double"
    from footfall.model import ACTION_WEIGHTS

    full = [("1", u, "11", i, k, t, n, k in (1, 2), ACTION_WEIGHTS[k]) for n, (u, i, k, t) in enumerate(rows)]
    return H.daily_detail(spark.createDataFrame(full, schema), P)


def test_filter_list(spark):
    t = NOW - 3600
    rows = [("10001", "a", 5, t)] * 2 + [("10001", "b", 5, t)] + [("10001", "c", 1, t)] * 3 + [("10001", "d", 1, t)] * 2
    rows += [("10001", "a", 1, t)] * 4
    rows += [("10002", "c", 1, t)] * 5  # impressions only: no list
    rows += [("10003", "z", 5, NOW - 5 * 86400)] + [("10003", "c", 1, t)] * 5  # old action, recent impressions
    d = detail(spark, rows)
    got = filtering.user_filter_list(filtering.filter_scores(d, P), d, P).collect()
    assert sorted((r.user_id, r["rank"], r.item_id, r.source, r.score) for r in got) == [
        ("10001", 1, "a", "action", 2.4), ("10001", 2, "b", "action", 1.0), ("10001", 3, "a", "impress", 0.4),
        ("10003", 1, "c", "impress", 0.5),
    ]


def test_detail_cap_and_nesting(spark):
    rows = [("10001", f"i{n}", 5, NOW - 3600 - n) for n in range(5)] + [("10001", "i4", 12, NOW - 90000)]
    d = H.cap_day_items(detail(spark, rows).where("counts_as_action").drop("counts_as_action", "is_impression"), 2)
    nested = H.nest_detail(d).collect()
    assert len(nested) == 1
    assert [(s.day, [i.item_id for i in s["items"]]) for s in nested[0].segments] == [(20240130, ["i0", "i1"]), (20240129, ["i4"])]
    flat = H.flatten_detail(H.nest_detail(d)).select(d.columns)
    assert sorted(flat.collect()) == sorted(d.collect())


def test_recent(spark):
    schema = "bid string, user_id string, uid string, item_id string, action_type int, action_time long, seq long"
    rows = [("1", "10001", "5", i, k, NOW - 100 + n, n) for n, (i, k) in enumerate([("a", 5), ("b", 5), ("a", 12), ("c", 5), ("d", 1)])]
    rows += [("1", "0", "5", "a", 5, NOW, 9), ("1", "0", "0", "a", 5, NOW, 10), ("1", "0", "", "a", 5, NOW, 11)]
    dim = spark.createDataFrame([], "bid string, item_id string, big_type long, mid_type long, small_type long, free int, price double, shop_id string, item_time long")
    got = ranking.user_recent(spark.createDataFrame(rows, schema), dim, P).collect()
    assert sorted((r.key, r["rank"], r.item_id, r.action_type) for r in got) == [
        ("1#10001#D1", 1, "c", 5), ("1#10001#D1", 2, "a", 12), ("1#5#D2", 1, "a", 5),
    ]


def test_ctr_is_never_null(spark):
    schema = "bid string, adpos string, item_id string, action_result string, group_id string, action_type int, action_time long"
    rows = [("1", "1", "p", "a#1;b;", "11", 1, NOW)] * 4 + [("1", "1", "p", "a", "21", 2, NOW)] + [("1", "1", "p", "c", "0", 2, NOW)]
    rows += [("1", "1", "", "a", "11", 2, NOW), ("1", "1", "p", "a", "11", 2, NOW - 9 * 86400)]
    daily = ctr.ctr_daily(spark.createDataFrame(rows, schema))
    got = ctr.ctr(daily, P).collect()
    assert [(r.key, r.item_id, r.weight) for r in got] == [("1#p#1#A1001#0", "a", 0.25)]


def test_tags_and_profiles(spark):
    schema = "bid string, item_id string, item_time long, big_type_name string, mid_type_name string, small_type_name string"
    dim = spark.createDataFrame([("1", "a", NOW, "sport", "ball", ""), ("1", "b", NOW - 9, "sport", "北京", "x"), ("1", "c", NOW - 99, "sport", "", "")], schema)
    scored = spark.createDataFrame([("1", "a", "cup", 0.7)], "bid string, item_id string, tag string, weight double")
    tags = content.item_tags(dim, scored)
    assert {(r.item_id, r.tag, r.level) for r in tags.collect()} == {
        ("a", "sport", 0), ("a", "ball", 1), ("a", "cup", 3), ("b", "sport", 0), ("b", "北京", 1), ("b", "x", 2), ("c", "sport", 0),
    }
    index = content.tag_index(tags, P, min_day=20240129).where("tag = 'sport'").orderBy("rank")
    assert [r.item_id for r in index.collect()] == ["a", "b"]
    index = content.tag_index(tags, replace(P, tag_index_size=9), min_day=20240130).where("tag = 'sport'")
    assert [r.item_id for r in index.collect()] == ["a"]
    actions = spark.createDataFrame([("1", "10001", "a", 5, NOW), ("1", "10001", "b", 9, NOW), ("1", "10001", "b", 1, NOW)], "bid string, user_id string, item_id string, action_type int, action_time long")
    profile = content.user_profile(actions, tags, P, content.default_denied_tags())
    got = {r.tag: (r.weight, r.level) for r in profile.collect()}
    assert got == {"sport": (0.475, 0), "ball": (0.375, 1), "cup": (0.375, 3), "x": (0.1, 2)}
    assert [r.tag for r in content.profile_top_tags(profile, P).orderBy("rank").collect()] == ["sport", "ball"]
    denied = spark.createDataFrame([("sport",)], "tag string")
    assert content.user_profile(actions, tags, P, denied).where("tag = 'sport'").count() == 0


def test_classifier_learns(spark):
    rows = [(i, "red apple fruit", "food") if i % 2 else (i, "fast car engine", "auto") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, text string, label string")
    model = content.fit_classifier(df, features=64)
    scored = content.classify_items(df.drop("label"), model, ["id"], min_weight=0.5)
    assert scored.join(df, "id").where(F.col("tag") != F.col("label")).count() == 0
    assert scored.count() == 40

"""Continuous lists against the batch operators on all events so far, after every micro-batch."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from footfall.model import HISTORY_SCHEMA, Params
from footfall.operators import content, enrich, filtering, history as H, popularity, ranking, similarity
from footfall.sources import dimensions as D
from footfall.streaming import dimensions, increments, ranked, seen, toplists, users
from tests.model import START, frame, random_history

NOW = {"availableNow": True}
DAY = 86400


def kill_last_commit(folder):
    """As if the job had died before its last batch was committed."""
    last = max(int(p.name) for p in (folder / "commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (folder / "commits" / name).unlink(missing_ok=True)


def items(spark, n=7):
    rows = [("1", f"i{k}", k % 2 + 1, k % 3, 0, 1, 9.5, "s", START + 20 * DAY) for k in range(n - 1)]
    rows.append(("1", f"i{n - 1}", 1, 1, 0, 1, 9.5, "s", START))  # too old for any list
    return spark.createDataFrame(
        rows, "bid string, item_id string, big_type long, mid_type long, small_type long, free int, price double, shop_id string, item_time long"
    )


def batch_lists(spark, rows, dim, p):
    h = frame(spark, rows)
    totals = popularity.item_total(h, p)
    candidates = (
        popularity.hot_items(totals)
        .unionByName(enrich.category_candidates(totals, "big_type"))
        .unionByName(similarity.item_cf(similarity.pair_total(h, p), totals))
    )
    enriched = enrich.enrich_results(candidates, dim).withColumn("update_time", F.lit(p.as_of).cast("long"))
    return sorted((r["key"], r["rank"], r.item_id, round(r.weight, 9)) for r in ranking.top_results(enriched, p).collect())


@pytest.mark.parametrize("seed,reserve", [(21, 2)])
def test_top_lists_after_every_batch(spark, tmp_path, seed, reserve):
    """Late rows, rows too late to count, a day that passes, a replay, folding, and lists that fall short of their reserve."""
    rows = random_history(seed, n=110, days=12)
    early = Params(as_of=START, result_size=2, hot_item_ttl_seconds=30 * DAY, item_ttl_seconds=30 * DAY)
    dim = items(spark)
    cut = [rows[:40] + rows[60:65], rows[40:60], rows[65:]]
    too_late = [(*rows[0][:5], START - 40 * DAY, 9000 + i, *rows[0][7:]) for i in range(3)]
    cut[2] = cut[2] + too_late
    t = toplists.tables(spark, f"{tmp_path}/t", buckets=4)
    so_far = []

    def start():
        source = spark.readStream.schema(HISTORY_SCHEMA).parquet(f"{tmp_path}/in")
        toplists.start_top_lists(source, t, f"{tmp_path}/cp", early, dim, trigger=NOW, compact_every=2, reserve=reserve).awaitTermination()

    for i, part in enumerate(cut):
        frame(spark, part, 2).write.mode("append").parquet(f"{tmp_path}/in")
        start()
        if i == 1:
            kill_last_commit(tmp_path / "cp")
            start()
        so_far += part
        clock = max(r[5] for r in so_far) // DAY * DAY + DAY
        p = replace(early, as_of=clock)
        got = ranked.served(t.lists, dim, p)
        assert sorted((r["key"], r["rank"], r.item_id, round(r.weight, 9)) for r in got.collect()) == batch_lists(spark, so_far, dim, p)
    late = {r.day: r.n for r in t.late.read().groupBy("day").agg(F.sum("n").alias("n")).collect()}
    assert sum(late.values()) >= 3 and late[20231216] == 3


def test_merge_falls_back_when_a_list_falls_short(spark, tmp_path):
    table = ranked.list_table(spark, f"{tmp_path}/lists", 4)
    weights = {f"i{k}": 10.0 - k for k in range(8)}
    kind = "bid string, owner string, alg_name string, group_id string, item_id string, weight double"
    entries = lambda w: spark.createDataFrame([("1", "o", "C1001", "11", i, x) for i, x in w.items()], kind)
    asked = []

    def everything(lists):
        asked.append(lists.count())
        return entries(weights)

    def apply(changes, batch):
        weights.update(changes)
        ranked.merge(table, entries(changes), batch, n=2, reserve=3, alive=lambda r: r, everything=everything)
        rows = table.latest(ranked.OWNER).where("item_id is not null").orderBy(F.desc("weight"), "item_id").limit(2).collect()
        assert [(r.item_id, r.weight) for r in rows] == sorted(((i, x) for i, x in weights.items() if x > 0), key=lambda e: (-e[1], e[0]))[:2]

    apply(dict(weights), 0)
    apply({"i0": 6.5}, 1)  # i1, i2 still lead
    assert asked == []
    apply({"i1": 0.0, "i2": 1.0}, 2)  # i3 was left out and must come back
    assert asked == [1]
    apply({i: 0.0 for i in weights}, 3)
    assert table.latest(ranked.OWNER).where("item_id is not null").count() == 0
    apply({"i5": 1.0}, 4)


@pytest.mark.parametrize("link", [2 * DAY])
def test_pair_increment_in_order(spark, tmp_path, link):
    rows = random_history(61, n=140, days=7)
    p = Params(as_of=START + 9 * DAY, link_seconds=link)
    table = increments.pair_table(spark, f"{tmp_path}/pairs", 4)
    for part in (rows[:50], rows[50:60], rows[60:]):
        frame(spark, part, 2).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(HISTORY_SCHEMA).parquet(f"{tmp_path}/in")
        increments.start_pair_increment(source, table, f"{tmp_path}/cp", p, NOW, compact_every=2).awaitTermination()
    want = similarity.pair_increment(frame(spark, rows), p)
    got = table.totals(["bid", "item_a", "item_b", "day", "group_id"], "weight").select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_pair_increment_keeps_nothing_per_user_in_tasks(spark, tmp_path):
    rows = random_history(62, n=60, days=4)
    p = Params(as_of=START)  # the clock moves on with the events
    table = increments.pair_table(spark, f"{tmp_path}/pairs", 2)
    for part in (rows[:40], rows[40:]):
        frame(spark, part, 2).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(HISTORY_SCHEMA).parquet(f"{tmp_path}/in")
        query = increments.start_pair_increment(source, table, f"{tmp_path}/cp", p, NOW)
        query.awaitTermination()
        assert all(not x["stateOperators"] for x in query.recentProgress)
    want = similarity.pair_increment(frame(spark, rows), replace(p, as_of=START + 9 * DAY))
    got = table.totals(["bid", "item_a", "item_b", "day", "group_id"], "weight").select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def actions(rows):
    """Actions of HISTORY_SCHEMA rows: every third has no user but a uid."""
    return [
        (r[6], r[0], "0" if r[6] % 3 == 0 else r[1], f"u{r[1]}", r[3], r[4], r[5], f"p{r[6] % 4}", f"l{r[6] % 5}") for r in rows if not r[7]
    ]


ACTIONS = "seq long, bid string, user_id string, uid string, item_id string, action_type int, action_time long, platform string, lbs_info string"


def run_parts(spark, tmp_path, rows, schema, start):
    for part in rows:
        spark.createDataFrame(part, schema).repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
        start(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")).awaitTermination()


def test_user_recent_in_any_order(spark, tmp_path):
    rows = actions(random_history(31, n=160, items=9))
    random.Random(3).shuffle(rows)
    p = Params(as_of=START + 8 * DAY, recent_size=4, recent_ttl_days=30)
    table = users.recent_table(spark, f"{tmp_path}/recent", 4)
    start = lambda s: users.start_user_recent(s, table, f"{tmp_path}/cp", p, 30 * DAY, trigger=NOW, compact_every=2)
    run_parts(spark, tmp_path, [rows[:40], rows[40:90], rows[90:]], ACTIONS, start)
    want = ranking.user_recent(spark.createDataFrame(rows, ACTIONS), items(spark, 9), p)
    got = users.served_recent(table, items(spark, 9), p).select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect()) and {"platform", "lbs_info"} <= set(want.columns)


def test_user_lists_keep_nothing_per_key_in_tasks(spark, tmp_path):
    """Lists are merged from tables: no state, also for actions later than the delay, and a batch that runs again."""
    act = lambda seq, user, day, item="i1": (seq, "1", user, "u", item, 5, START + day * DAY, "p", "l")
    p, queries = Params(as_of=START + 7 * DAY, recent_size=3), []
    table = users.recent_table(spark, f"{tmp_path}/recent", 2)
    profiles = users.profile_table(spark, f"{tmp_path}/profiles", 2)
    tags = spark.createDataFrame([("1", f"i{k}", f"t{k % 2}", 0) for k in range(4)], "bid string, item_id string, tag string, level int")

    def start(s):
        queries.append(users.start_user_profile(s, tags, profiles, f"{tmp_path}/cp2", p, trigger=NOW, compact_every=1))
        queries[-1].awaitTermination()
        queries.append(users.start_user_recent(s, table, f"{tmp_path}/cp", p, 60, trigger=NOW, compact_every=1))
        return queries[-1]

    parts = [[act(1, "10001", 6), act(2, "10001", 6, "i2")], [act(3, "10001", 2, "i3")]]
    run_parts(spark, tmp_path, parts, ACTIONS, start)
    for name in ("cp", "cp2"):
        kill_last_commit(tmp_path / name)
    start(spark.readStream.schema(ACTIONS).parquet(f"{tmp_path}/in")).awaitTermination()
    assert all(not x["stateOperators"] for q in queries for x in q.recentProgress)
    rows = spark.createDataFrame([r for part in parts for r in part], ACTIONS)
    got = users.served_recent(table, items(spark), p)
    assert sorted((r["rank"], r.item_id) for r in got.collect()) == [(1, "i2"), (2, "i1"), (3, "i3")]
    want = content.profile_top_tags(content.user_profile(rows, tags, p), p)
    assert sorted(users.served_profiles(profiles).select(want.columns).collect()) == sorted(want.collect())


def test_recent_lists_end(spark, tmp_path):
    act = lambda seq, user, day, item="i1": (seq, "1", user, "u", item, 5, START + day * DAY, "p", "l")
    p = Params(as_of=START)
    table = users.recent_table(spark, f"{tmp_path}/recent", 4)
    start = lambda s: users.start_user_recent(s, table, f"{tmp_path}/cp", p, DAY, trigger=NOW)
    parts = [[act(1, "10001", 0), act(2, "10002", 0)], [act(3, "10001", 5), act(4, "10003", 9)], [act(5, "10003", 9, "i2")], [act(6, "10003", 10)]]
    run_parts(spark, tmp_path, parts, ACTIONS, start)
    alive = {r["key"] for r in table.latest(["key"]).where("rank > 0").collect()}
    assert alive == {"1#10001#D1", "1#10003#D1"}  # 10002 had nothing new for seven days
    served = users.served_recent(table, items(spark), replace(p, as_of=START + 12 * DAY))
    assert {r["key"] for r in served.collect()} == {"1#10003#D1"}


def test_user_profile_state(spark, tmp_path):
    rows = [(r[0], r[1], r[3], r[4], r[5]) for r in random_history(41, n=150)]
    kind = "bid string, user_id string, item_id string, action_type int, action_time long"
    tags = [("1", f"i{k}", t, lv) for k in range(7) for t, lv in ((f"t{k % 3}", 0), (f"s{k % 4}", 1), ("denied", 2), ("t0", 2))]
    tags = spark.createDataFrame(tags, "bid string, item_id string, tag string, level int")
    p = Params(as_of=START + 30 * DAY, profile_size=3)
    override = spark.createDataFrame([(12, 0.7), (3, 0.1)], "action_type int, weight double")
    table = users.profile_table(spark, f"{tmp_path}/profiles", 4)
    start = lambda s: users.start_user_profile(s, tags, table, f"{tmp_path}/cp", p, ["denied"], override, NOW, 2)
    run_parts(spark, tmp_path, [rows[:50], rows[50:51], rows[51:]], kind, start)
    full = content.user_profile(spark.createDataFrame(rows, kind), tags, p, ["denied"], override)
    want = content.profile_top_tags(full, p)
    got = users.served_profiles(table).select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())
    same = content.user_profile(spark.createDataFrame(rows, kind), tags, p, ["denied"], {12: 0.7, 3: 0.1})
    assert sorted(full.collect()) == sorted(same.collect())


def test_profile_tags_are_forgotten(spark, tmp_path):
    """With a lifetime of no time at all only the newest batch's tags are left."""
    kind = "bid string, user_id string, item_id string, action_type int, action_time long"
    tags = spark.createDataFrame([("1", "a", "ta", 0), ("1", "b", "tb", 0)], "bid string, item_id string, tag string, level int")
    p = replace(Params(as_of=START), profile_ttl_days=0)
    table = users.profile_table(spark, f"{tmp_path}/profiles", 2)
    processor = users.ProfileTags
    try:
        users.ProfileTags = lambda size, ttl: processor(size, 1)
        start = lambda s: users.start_user_profile(s, tags, table, f"{tmp_path}/cp", p, trigger=NOW)
        run_parts(spark, tmp_path, [[("1", "10001", "a", 5, START)], [("1", "10001", "b", 5, START)]], kind, start)
    finally:
        users.ProfileTags = processor
    assert [r.tag for r in users.served_profiles(table).collect()] == ["tb"]


def test_filter_lists_after_every_batch(spark, tmp_path):
    rows = random_history(51, n=160, days=9)
    p = Params(as_of=START, filter_size=3, filter_impress_days=2, retention_days=4)
    t = seen.tables(spark, f"{tmp_path}/t", 4)
    too_late = [(*rows[-1][:5], START - 9 * DAY, 9000, *rows[-1][7:])]
    parts, so_far = [rows[:50] + rows[70:80], rows[50:70], rows[80:] + too_late], []

    def start():
        source = spark.readStream.schema(HISTORY_SCHEMA).parquet(f"{tmp_path}/in")
        seen.start_filter_lists(source, t, f"{tmp_path}/cp", p, trigger=NOW, compact_every=1).awaitTermination()

    for i, part in enumerate(parts):
        frame(spark, part, 2).write.mode("append").parquet(f"{tmp_path}/in")
        start()
        if i == 1:
            kill_last_commit(tmp_path / "cp")
            start()
        so_far += part
        at = replace(p, as_of=max(r[5] for r in so_far) // DAY * DAY + DAY)
        detail = H.daily_detail(frame(spark, so_far), at)
        want = filtering.user_filter_list(filtering.filter_scores(detail, at), detail, at)
        assert sorted(seen.served(t).select(want.columns).collect()) == sorted(want.collect())
    late = t.late.read().agg(F.sum("n")).first()[0]
    counted = sum(r[5] >= START + 9 * DAY - 4 * DAY - 9 * DAY for r in so_far)
    assert late >= 1 and late + counted >= len(so_far)


def item_line(seq, item, day, price, cate="3"):
    fields = [day, "1", item, cate, "2", "1", "big", "mid", "small", "1", "1", price, "text", str(START), "0", "1", ""]
    return (seq, "iname=ItemInfo", "|".join(fields))


def test_item_ranges_from_a_stream(spark, tmp_path):
    lines = [
        item_line(1, "a", "20240126", "5.0"), item_line(2, "a", "20240124", "3.5"), item_line(3, "a", "20240126", "6.0"), item_line(4, "b", "20240125", ""),
        item_line(5, "b", "20240199", "1"), item_line(6, "c", "20240125", "free"), item_line(7, "c", "", "1"), item_line(8, "", "20240125", "1"), item_line(9, "a", "20240128", "7"),
    ]
    schema = "seq long, attr string, line string"
    t = dimensions.tables(spark, f"{tmp_path}/t", 4)
    start = lambda s: dimensions.start_items(s, t, f"{tmp_path}/cp", NOW, compact_every=1)
    run_parts(spark, tmp_path, [lines[6:], lines[:2], lines[2:6]], schema, start)
    at = lambda d: START + (d - 25) * DAY  # noqa: E731  (START is the 25th)
    got = sorted((r.item_id, r.price, r.valid_from, r.valid_to) for r in dimensions.ranges(t).collect())
    assert got == [("a", 3.5, at(24), at(26)), ("a", 6.0, at(26), at(28)), ("a", 7.0, at(28), D.FOREVER), ("b", None, at(25), D.FOREVER)]
    assert {r.seq: r.reason for r in t.rejects.read().collect()} == {5: "bad_imp_date", 6: "bad_price", 7: "missing_imp_date", 8: "empty_item"}
    assert sorted((r.item_id, r.price) for r in dimensions.current(t).collect()) == [("a", 7.0), ("b", None)]
    times = [("1", "a", at(d) + 5) for d in (23, 24, 25, 26, 27, 28, 40)] + [("1", "zzz", at(26))]
    rows = spark.createDataFrame(times, "bid string, item_id string, action_time long")
    got = enrich.enrich_items_as_of(rows, dimensions.ranges(t)).collect()
    assert sorted((r.action_time, r.item_id, r.price, r.big_type) for r in got) == sorted(
        [(at(23) + 5, "a", 0, 0), (at(24) + 5, "a", 3, 3), (at(25) + 5, "a", 3, 3), (at(26) + 5, "a", 6, 3), (at(27) + 5, "a", 6, 3), (at(28) + 5, "a", 7, 3), (at(40) + 5, "a", 7, 3), (at(26), "zzz", 0, 0)]
    )

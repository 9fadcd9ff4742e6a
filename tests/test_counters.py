"""Item and pair counters against the event-by-event model, with and without salting."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from footfall.model import ACTION_WEIGHTS, Params
from footfall.operators import popularity, segments as S, similarity
from tests.model import START, day, frame, item_contributions, pair_contributions, random_history

P = Params(as_of=START + 10 * 86400)
LINKS = [86400, 3 * 86400, 6 * 3600]


def collect_pairs(df):
    out = {}
    for r in df.collect():
        key = (r.user_id, r.group_id, r.item_a, r.item_b, r.day)
        out[key] = out.get(key, 0) + r.weight
    return out


@pytest.mark.parametrize("link", LINKS)
@pytest.mark.parametrize("seed", [1, 2])
def test_item_weight_matches_model(spark, seed, link):
    rows = random_history(seed)
    got = popularity.user_item_weight(frame(spark, rows), replace(P, link_seconds=link))
    assert {(r.user_id, r.group_id, r.item_id): (r.day, r.weight) for r in got.collect()} == item_contributions(rows, link)


@pytest.mark.parametrize("link", LINKS)
@pytest.mark.parametrize(("seed", "split"), [(1, 1_000_000), (1, 5), (2, 5)])
def test_pair_weight_matches_model(spark, seed, split, link):
    """With ``split`` 5 nearly every user-day counts as hot: it is thinned and salted."""
    rows = random_history(seed)
    got = similarity.user_pair_weight(frame(spark, rows), replace(P, link_seconds=link, rows_per_split=split))
    assert collect_pairs(got) == pair_contributions(rows, link)


def test_salting_changes_nothing(spark):
    """Every key counts as hot when one task may see five rows."""
    rows = frame(spark, random_history(3))
    split = replace(P, rows_per_split=5)
    for fn in (similarity.user_pair_weight, similarity.pair_increment, similarity.item_neighbours):
        assert sorted(fn(rows, P).collect()) == sorted(fn(rows, split).collect())


@pytest.mark.parametrize("split", [1_000_000, 5])
def test_pair_weight_reads_the_history_once(spark, split):
    rows = random_history(3)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(user):
        read.add(1)
        return user

    history = frame(spark, rows).withColumn("user_id", counted("user_id"))
    similarity.user_pair_weight(history, replace(P, rows_per_split=split)).collect()
    assert 0 < read.value <= len(rows)


def test_hot_keys_are_few_written_rows(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, "u").otherwise(F.col("id").cast("string")).alias("k"))
    hot = S.hot_keys(rows, ["k"], replace(P, rows_per_split=100))
    assert [tuple(r) for r in hot.collect()] == [("u", 900)]
    plan = rows.join(hot, "k", "left")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "FileScan parquet" in plan


def test_split_hot_spreads_a_hot_key(spark):
    left = spark.range(1000).select(F.lit("u").alias("k"), F.concat(F.lit("i"), "id").alias("item"))
    right = spark.createDataFrame([("u", 1), ("u", 2), ("v", 3)], "k string, x int")
    a, b = S.split_hot(left, right, ["k"], "item", replace(P, rows_per_split=100))
    assert a.groupBy("salt").count().agg(F.max("count")).first()[0] < 200
    assert a.join(b, ["k", "salt"]).count() == 2000


def test_pruned_history_gives_the_same_totals(spark):
    rows = frame(spark, random_history(4))
    p = replace(P, as_of=START + 6 * 86400, retention_days=2)
    full = popularity.windowed_total(popularity.item_count(rows, p), ["bid", "item_id"], p)
    assert sorted(full.collect()) == sorted(popularity.item_total(rows, p).select(full.columns).collect())
    pairs = popularity.windowed_total(similarity.pair_count(rows, p), ["bid", "item_a", "item_b"], p)
    assert sorted(pairs.collect()) == sorted(similarity.pair_total(rows, p).select(pairs.columns).collect())


def test_overall_group_is_the_sum_of_the_groups(spark):
    counts = popularity.item_count(frame(spark, random_history(5)), P)
    sums = counts.groupBy("bid", "item_id", "day").agg(
        F.sum(F.when(F.col("group_id") == "0", F.col("weight"))).alias("all"),
        F.sum(F.when(F.col("group_id") != "0", F.col("weight"))).alias("parts"),
    )
    assert sums.where("all <> parts or all is null").count() == 0


def test_users_without_a_valid_group_never_count(spark):
    rows = [(*r[:2], "99", *r[3:]) for r in random_history(6, n=50)]
    assert popularity.item_count(frame(spark, rows), P).count() == 0
    assert similarity.pair_count(frame(spark, rows), P).count() == 0


def test_best_weight_of_a_long_history(spark):
    """25 days × 199 items, types 1, 2 and 3 daily and type 7 until the 24th: a type 3
    action on the 26th with a 7-day window is worth type 7 of the 24th."""
    first = 1391299200  # 2014-02-02
    rows, seq = [], 0
    for d in range(25):
        t = first + d * 86400
        for item in range(1, 200):
            kinds = [3, 2, 1] + ([7] if day(t) <= 20140224 else [])
            for kind in kinds:
                rows.append(("2", "10001", "51", str(item), kind, t, seq, kind in (1, 2), ACTION_WEIGHTS[kind]))
                seq += 1
    p = Params(as_of=first + 30 * 86400, link_seconds=7 * 86400)
    got = popularity.user_item_weight(frame(spark, rows), p).where("item_id = '123'").first()
    assert (got.weight, got.day) == (2.0, 20140224)


def test_cosine_is_symmetric_and_bounded_lists(spark):
    rows = frame(spark, random_history(7))
    cf = similarity.item_cf(similarity.pair_total(rows, P), popularity.item_total(rows, P))
    parts = F.split("key", "#")
    ways = cf.select(parts[1].alias("a"), F.col("item_id").alias("b"), parts[4].alias("g"), "weight")
    back = ways.select(F.col("a").alias("b"), F.col("b").alias("a"), "g", F.col("weight").alias("other"))
    assert ways.join(back, ["a", "b", "g"]).where("abs(weight - other) > 1e-12").count() == 0
    assert ways.join(back, ["a", "b", "g"], "left_anti").count() == 0


def test_baskets_with_one_hot_basket(spark):
    rows = [(b, i) for b in range(30) for i in range(b % 5)] + [(99, i) for i in range(40)] * 2
    df = spark.createDataFrame(rows, "basket int, item int")
    members = set(rows)
    count = {}
    for b, i in members:
        count[i] = count.get(i, 0) + 1
    want = {}
    for b, i in members:
        for c, j in members:
            if b == c and i != j:
                want[(i, j)] = want.get((i, j), 0) + 1
    want = {k: round(v / (count[k[0]] * count[k[1]]) ** 0.5, 9) for k, v in want.items()}
    for limit in (1_000_000, 10):
        got = similarity.basket_cf(df, "basket", "item", replace(P, rows_per_split=limit))
        assert {(r["item"], r.other): round(r.weight, 9) for r in got.collect()} == want


def test_arrival_number_out_of_range_fails(spark):
    row = list(random_history(8, n=1)[0])
    row[6] = 1 << 46
    with pytest.raises(Exception, match="seq out of range"):
        S.segments(frame(spark, [tuple(row)]), P).collect()


def test_basket_tasks_follow_the_pairs(spark):
    """More pairs, more tasks, the same result; a task's share of the pairs stays bounded."""
    rows = spark.range(600).select((F.col("id") % 40).alias("b"), F.pmod(F.hash("id"), F.lit(50)).alias("i"))
    few, many = similarity.basket_cf(rows, "b", "i", P), similarity.basket_cf(rows, "b", "i", P, pairs_per_task=50)
    assert sorted(few.collect()) == sorted(many.collect())
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    members = rows.distinct()
    other = members.withColumnRenamed("i", "j")
    n = members.join(other, "b").where("i < j").count()
    assert "RepartitionByExpression [item_a#" in plan and f", {n // 50 + 1}" in plan

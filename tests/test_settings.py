"""Configuration that changes between micro-batches: in force at the next one, unchanged in a replay."""

from footfall.model import Params
from footfall.streaming import settings

NOW = {"availableNow": True}
START = 1706140800
ACTIONS = "seq long, bid string, topic string, user_id string, item_id string, action_type int, action_time long"


def act(seq, item, kind=5, user="10001"):
    return (seq, "1", "user_action", user, item, kind, START + seq)


def test_changes_between_batches(spark, tmp_path):
    tags = [("1", "a", "ta", 0), ("1", "b", "tb", 0), ("1", "b", "place", 1)]
    tags = spark.createDataFrame(tags, "bid string, item_id string, tag string, level int")
    t = settings.tables(spark, f"{tmp_path}/t", 4)
    weights = lambda *r: spark.createDataFrame(list(r), "action_type int, weight double")
    denied = lambda *r: spark.createDataFrame([(x,) for x in r], "tag string")
    rule = lambda high: spark.createDataFrame(
        [("1", "user_action", 0, "user_id", True, None), ("1", "user_action", 1, "action_type", False, f"[1,{high}]")], settings.R.RULE_SCHEMA
    )

    def start(rows=()):
        if rows:
            spark.createDataFrame(list(rows), ACTIONS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(ACTIONS).parquet(f"{tmp_path}/in")
        settings.start_profiles(source, tags, t, f"{tmp_path}/cp", NOW, compact_every=3).awaitTermination()

    def sums():
        return {(r.user_id, r.tag): r.tenths for r in settings._folded(t.sums.read()).collect()}

    start([act(1, "a"), act(2, "b", 12)])  # no settings yet: built-in weights, type 12 has none
    assert sums() == {("10001", "ta"): 15}
    t.weights.publish(weights((12, 0.7)))
    t.denied.publish(denied("place"))
    t.rules.publish(rule(12))
    start([act(3, "b", 12), act(4, "a", 13), act(5, "a")])
    assert sums() == {("10001", "ta"): 30, ("10001", "tb"): 7}
    assert [(r.seq, r.reason) for r in t.rejects.read().collect()] == [(4, "bad_action_type")]
    # The settings change, and the last batch runs again: it must see what it saw.
    t.weights.publish(weights((12, 9.0), (5, 0.1)))
    t.denied.publish(denied())
    t.rules.publish(rule(99))
    for name in ("1", ".1.crc"):
        (tmp_path / "cp/commits" / name).unlink(missing_ok=True)
    start()
    assert sums() == {("10001", "ta"): 30, ("10001", "tb"): 7}
    start([act(6, "b", 12), act(7, "a", 13, "10002")])
    assert sums() == {("10001", "ta"): 30, ("10001", "tb"): 97, ("10001", "place"): 90, ("10002", "ta"): 5}
    start([act(8, "a")])  # folds the first batches
    got = settings.profiles(t, Params(as_of=START, profile_size=1))
    assert sorted((r.user_id, r.tag, r.weight, r["rank"]) for r in got.collect()) == [("10001", "tb", 2.425, 1), ("10002", "ta", 0.125, 1)]

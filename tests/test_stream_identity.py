"""Identity in the stream against the batch lookup: late records, records that never come, actions that waited too long."""

from footfall.operators import identity as batch
from footfall.streaming import identity

NOW = {"availableNow": True}
START = 1706140800
ACTIONS = "seq long, bid string, user_id string, uid string, action_type int, action_time long, item_id string"
RECORDS = "uid string, user_id string, record_time long"


def act(seq, user, uid, hour, item="i1"):
    return (seq, "1", user, uid, 5, START + hour * 3600, item)


def test_actions_wait_for_their_user(spark, tmp_path):
    actions = [
        [act(1, "10001", "a", 0), act(2, "0", "b", 0), act(3, "0", "c", 0), act(4, "0", "", 0), act(5, "0", "0", 0), act(6, None, "d", 1)],
        [act(7, "0", "b", 2), act(8, "0", "a", 2), act(9, "10009", None, 2)],
        [act(10, "0", "c", 3), act(11, "0", "d", 30, None)],
        [act(14, "10009", None, 31)],
        [act(12, "0", "d", 31), act(13, "0", "e", 60)],
    ]
    records = [[("a", "10001", 1), ("x", "10077", 1)], [("b", "10002", 1), ("b", "10003", 2)], [("c", "0", 1), ("c", "10004", 3)], [("y", "10088", 4)], [("d", "10005", 4)]]
    groups = spark.createDataFrame([("10002", "g,11,x"), ("10003", "g,21"), ("10004", "g|31|"), ("10001", "g,99")], "user_id string, value string")
    for i, (part, named) in enumerate(zip(actions, records, strict=True)):
        spark.createDataFrame(part, ACTIONS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/a")
        spark.createDataFrame(named, RECORDS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/r")
        source = spark.readStream.schema(ACTIONS).parquet(f"{tmp_path}/a")
        lookup = spark.readStream.schema(RECORDS).parquet(f"{tmp_path}/r")
        identity.start_identity(source, lookup, groups, f"{tmp_path}/out", f"{tmp_path}/cp", wait_seconds=20 * 3600, delay_seconds=3600, trigger=NOW).awaitTermination()
    got = {r.seq: (r.user_id, r.group_id) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    # 6 waited 20 hours for "d" and left as "0" before the record came; 11 and 12 got it; "e" still waits.
    want = {
        1: ("10001", "0"), 2: ("10003", "21"), 3: ("10004", "31"), 6: ("0", "0"), 7: ("10003", "21"), 8: ("10001", "0"),
        9: ("10009", "0"), 10: ("10004", "31"), 11: ("10005", "0"), 12: ("10005", "0"), 14: ("10009", "0"),
    }
    assert got == want
    uid_map = spark.createDataFrame([("a", "10001"), ("b", "10003"), ("c", "10004"), ("d", "10005")], "uid string, user_id string")
    rows = spark.createDataFrame([r for p in actions for r in p], ACTIONS)
    whole = {r.seq: (r.user_id, r.group_id) for r in batch.resolve_identity(rows, uid_map, groups).collect()}
    assert {k: v for k, v in whole.items() if k not in (6, 13)} == {k: v for k, v in got.items() if k != 6}
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(want)


def test_late_actions_stay_and_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    """An action a day behind the newest one still gets its user; rows of a batch appear once; tasks keep no state."""
    queries = []

    def start():
        source = spark.readStream.schema(ACTIONS).parquet(f"{tmp_path}/a")
        lookup = spark.readStream.schema(RECORDS).parquet(f"{tmp_path}/r")
        groups = spark.createDataFrame([("10001", "g,11,x")], "user_id string, value string")
        queries.append(identity.start_identity(source, lookup, groups, f"{tmp_path}/out", f"{tmp_path}/cp", 48 * 3600, trigger=NOW, buckets=2))
        queries[-1].awaitTermination()

    parts = [[act(1, "0", "a", 40), act(2, "0", "b", 40)], [act(3, "0", "a", 10)], [act(4, "0", "a", 41), act(5, "0", "b", 41)]]
    records = [[("x", "10009", 1)], [("y", "10008", 1)], [("a", "10001", 1)]]
    for part, named in zip(parts, records, strict=True):
        spark.createDataFrame(part, ACTIONS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/a")
        spark.createDataFrame(named, RECORDS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/r")
        start()
    last = max(int(p.name) for p in (tmp_path / "cp/commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "cp/commits" / name).unlink(missing_ok=True)
    start()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("seq", "user_id", "group_id").collect()) == [
        (1, "10001", "11"), (3, "10001", "11"), (4, "10001", "11")
    ]
    assert all(not p["stateOperators"] for q in queries for p in q.recentProgress)

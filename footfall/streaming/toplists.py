"""Continuous hot, category and item-item lists by delta propagation.

After every micro-batch the lists are what the batch operators give for all events so far:

1. The batch's users are looked up in the stored events; with and without the batch their contributions to items and
   pairs are computed by the batch operators, and the differences go to the day counters.
2. An item total that changes touches the cosine of all the item's pairs. The touched pairs (changed pairs and
   pairs of changed items) are joined with both totals and give new candidate weights, in both directions; changed totals
   are candidates of the hot and category lists themselves.
3. ``ranked.merge`` applies the candidates to their lists.

The clock is the end of the newest event's day. When it passes a day, what the retention window loses counts as changed.
Events that no counter can take any more are counted per day in ``late`` and left out, so received = stored + late.

All tables are bucketed by what they are looked up by: events by user, counters by item, lists by list. Pairs are stored in both
directions, so the pairs of an item lie in its bucket.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import HISTORY_SCHEMA, Params
from footfall.operators import popularity, segments as S
from footfall.operators.popularity import CATEGORY_LEVELS, by_group
from footfall.session import materialize, scratch
from footfall.streaming import ranked
from footfall.streaming.keyed import BUCKETS, KeyedTable
from footfall.streaming.pairs import pair_changes
from footfall.streaming.store import BatchTable

ITEM_KEY = ["bid", "item_id", "group_id"]
PAIR_KEY = ["bid", "item_id", "other", "group_id"]
ITEM_SCHEMA = "bid string, item_id string, group_id string, day long, tenths long"
PAIR_SCHEMA = "bid string, item_id string, other string, group_id string, day long, tenths long"
EVENT_COLUMNS = [f.name for f in HISTORY_SCHEMA.fields]


@dataclass
class Tables:
    events: KeyedTable
    items: KeyedTable
    pairs: KeyedTable
    lists: KeyedTable
    clock: BatchTable
    late: BatchTable


def tables(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Tables:
    """The job's tables below one folder; ``buckets`` must be the same at every start."""
    return Tables(
        KeyedTable(spark, f"{path}/events", HISTORY_SCHEMA, ["bid", "user_id"], buckets),
        KeyedTable(spark, f"{path}/items", ITEM_SCHEMA, ["bid", "item_id"], buckets),
        KeyedTable(spark, f"{path}/pairs", PAIR_SCHEMA, ["bid", "item_id"], buckets),
        ranked.list_table(spark, f"{path}/lists", buckets),
        BatchTable(spark, f"{path}/clock", "newest long"),
        BatchTable(spark, f"{path}/late", "day long, n long"),
    )


def _day(time: int) -> int:
    return int(datetime.fromtimestamp(time, timezone.utc).strftime("%Y%m%d"))


def _reach(clock: int, p: Params) -> int:
    """Start of the oldest day whose events can still enter a counter of the retention window."""
    return (clock - p.retention_seconds - 2 * p.link_seconds) // M.DAY_SECONDS * M.DAY_SECONDS


def _tenths(rows: DataFrame) -> DataFrame:
    return rows.withColumn("tenths", F.round(F.col("weight") * 10).cast("long")).where(F.col("tenths") != 0)


class _Batch:
    """One micro-batch: its changes, and the counters as they are after it."""

    def __init__(self, t: Tables, batch_id: int, p: Params, dim_item: DataFrame, level: str):
        self.t, self.id, self.p, self.dim_item, self.level = t, batch_id, p, dim_item, level

    def advance(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Take in the events; returns (stored events of the batch's users, the batch's events that count)."""
        rows = materialize(S.countable(batch).select(*EVENT_COLUMNS), "batch")
        before = self.t.clock.read(self.id).agg(F.max("newest")).first()[0]
        newest = rows.agg(F.max("action_time")).first()[0]
        end = (max(newest or 0, 0) // M.DAY_SECONDS + 1) * M.DAY_SECONDS if newest is not None else 0
        now = max(before or 0, end, self.p.as_of)
        self.t.clock.append(self.t.clock.spark.createDataFrame([(now,)], "newest long"), self.id)
        self.p = replace(self.p, as_of=now)
        self.first_day = _day(now - self.p.retention_seconds)
        self.passed_from = _day(before - self.p.retention_seconds) if before else self.first_day
        oldest = _reach(now, self.p)
        late = rows.where(F.col("action_time") < oldest)
        self.t.late.append(late.groupBy(C.day_id("action_time").alias("day")).agg(F.count("*").alias("n")), self.id)
        fresh = rows.where(F.col("action_time") >= oldest)
        self.t.events.append(fresh, self.id)
        stored = self.t.events.lookup(fresh.select("bid", "user_id").distinct(), self.id)
        return materialize(stored.where(F.col("action_time") >= oldest).select(*EVENT_COLUMNS), "stored"), fresh

    def count(self, stored: DataFrame, fresh: DataFrame) -> None:
        """Signed changes of the day counters."""
        acted = fresh.select(*S.USER, "item_id").distinct()
        mine = stored.join(acted, [*S.USER, "item_id"], "left_semi")
        after = popularity.user_item_weight(mine.unionByName(fresh), self.p)
        gone = popularity.user_item_weight(mine, self.p).withColumn("weight", -F.col("weight"))
        items = _tenths(by_group(after.unionByName(gone), ["bid", "item_id", "day"]))
        self.items = materialize(items.select(*ITEM_KEY, "day", "tenths"), "item-changes")
        pairs = _tenths(by_group(pair_changes(stored, fresh, self.p), ["bid", "item_a", "item_b", "day"]))
        ways = F.array(
            F.struct(F.col("item_a").alias("item_id"), F.col("item_b").alias("other")),
            F.struct(F.col("item_b").alias("item_id"), F.col("item_a").alias("other")),
        )
        self.pairs = materialize(pairs.select("bid", F.inline(ways), "group_id", "day", "tenths").select(*PAIR_KEY, "day", "tenths"), "pair-changes")
        self.t.items.append(self.items, self.id)
        self.t.pairs.append(self.pairs, self.id)

    def _changed(self, changes: DataFrame, table: KeyedTable, key: list[str]) -> DataFrame:
        """Keys whose total of the window moved: changed days in it, and days it has passed since the last batch."""
        keys = changes.where(F.col("day") >= self.first_day).select(*key)
        if self.passed_from < self.first_day:
            passed = table.read(self.id + 1).where((F.col("day") >= self.passed_from) & (F.col("day") < self.first_day))
            keys = keys.unionByName(passed.select(*key))
        return materialize(keys.distinct(), "changed-keys")

    def _window(self, rows: DataFrame, key: list[str]) -> DataFrame:
        """Totals of the window, also where they are zero now."""
        rows = rows.where(F.col("day") >= min(self.passed_from, self.first_day))
        return rows.groupBy(*key).agg(F.sum(F.when(F.col("day") >= self.first_day, F.col("tenths")).otherwise(0)).alias("tenths"))

    def _item_totals(self, items: DataFrame) -> DataFrame:
        return self._window(self.t.items.lookup(items.select("bid", "item_id").distinct(), self.id + 1), ITEM_KEY)

    def _pair_totals(self, items: DataFrame) -> DataFrame:
        return self._window(self.t.pairs.lookup(items.select("bid", "item_id").distinct(), self.id + 1), PAIR_KEY)

    def _similar(self, pairs: DataFrame) -> DataFrame:
        """Candidates of the item-item lists: ``item_id`` owns the list, ``other`` is on it."""
        pairs = materialize(pairs.select(*PAIR_KEY, "tenths"), "touched-pairs")
        totals = self._item_totals(pairs.select("bid", "item_id").unionByName(pairs.select("bid", F.col("other").alias("item_id"))))
        totals = materialize(totals, "touched-totals")
        first = totals.withColumnRenamed("tenths", "_a")
        second = totals.select("bid", F.col("item_id").alias("other"), "group_id", F.col("tenths").alias("_b"))
        rows = pairs.join(first, ITEM_KEY, "left").join(second, ["bid", "other", "group_id"], "left")
        known = rows.fillna(0, ["_a", "_b"])
        weight = C.cosine_weight(F.col("tenths") / 10.0, F.col("_a") / 10.0, F.col("_b") / 10.0)
        list_id = F.when(F.col("group_id") == M.OVERALL_GROUP, M.LIST_CF_OVERALL).otherwise(M.LIST_CF)
        return known.select(
            "bid", F.col("item_id").alias("owner"), list_id.alias("alg_name"), "group_id", F.col("other").alias("item_id"), weight.alias("weight")
        )

    def _hot(self, totals: DataFrame) -> DataFrame:
        overall = F.col("group_id") == M.OVERALL_GROUP
        list_id = F.when(overall, M.LIST_HOT_OVERALL).otherwise(M.LIST_HOT)
        weight = (F.col("tenths") / 10.0).alias("weight")
        return totals.select("bid", F.lit("0").alias("owner"), list_id.alias("alg_name"), "group_id", "item_id", weight)

    def _by_category(self, totals: DataFrame) -> DataFrame:
        overall = F.col("group_id") == M.OVERALL_GROUP
        list_id = F.when(overall, M.LIST_CATEGORY_HOT_OVERALL).otherwise(M.LIST_CATEGORY_HOT)
        category = self.dim_item.where(F.col(self.level) > 0).select("bid", "item_id", F.col(self.level).cast("string").alias("owner"))
        rows = totals.join(category, ["bid", "item_id"])
        return rows.select("bid", "owner", list_id.alias("alg_name"), "group_id", "item_id", (F.col("tenths") / 10.0).alias("weight"))

    def candidates(self) -> DataFrame:
        """New weights of all candidates that the batch may have changed."""
        items = self._changed(self.items, self.t.items, ITEM_KEY)
        pairs = self._changed(self.pairs, self.t.pairs, PAIR_KEY)
        near = materialize(self._pair_totals(items.select("bid", "item_id").unionByName(pairs.select("bid", "item_id"))), "near-pairs")
        of_items = near.join(items, ITEM_KEY, "left_semi")
        mirrored = of_items.select("bid", F.col("other").alias("item_id"), F.col("item_id").alias("other"), "group_id", "tenths")
        touched = of_items.unionByName(mirrored).unionByName(near.join(pairs, PAIR_KEY, "left_semi")).distinct()
        totals = materialize(self._item_totals(items).join(items, ITEM_KEY, "left_semi"), "changed-totals")
        return self._similar(touched).unionByName(self._hot(totals)).unionByName(self._by_category(totals))

    def everything(self, lists: DataFrame) -> DataFrame:
        """All candidates of some lists."""
        owned = lists.select("bid", F.col("owner").alias("item_id"), "group_id", "alg_name")
        similar = owned.where(F.col("alg_name").isin(M.LIST_CF, M.LIST_CF_OVERALL)).drop("alg_name")
        pairs = self._pair_totals(similar).join(similar, ITEM_KEY, "left_semi")
        popular = lists.where(~F.col("alg_name").isin(M.LIST_CF, M.LIST_CF_OVERALL))
        rows = self._similar(pairs)
        if not popular.isEmpty():
            groups = popular.select("bid", "group_id").distinct()
            totals = self._window(self.t.items.read(self.id + 1).join(groups, ["bid", "group_id"], "left_semi"), ITEM_KEY)
            totals = materialize(totals, "all-totals")
            rows = rows.unionByName(self._hot(totals)).unionByName(self._by_category(totals))
        return rows.join(lists, ranked.OWNER, "left_semi")


def start_top_lists(
    history: DataFrame,
    t: Tables,
    checkpoint: str,
    p: Params,
    dim_item: DataFrame,
    level: str = "big_type",
    trigger: dict | None = None,
    compact_every: int = 0,
    reserve: int | None = None,
) -> StreamingQuery:
    """Maintain the hot, category and item-item lists from a history stream.

    ``reserve`` entries are stored per list, by default three times ``p.result_size``. With ``compact_every`` all tables are
    folded every so many batches, up to the last committed one; days that no later batch can reach are left out.
    """
    if level not in CATEGORY_LEVELS:
        raise ValueError(f"level must be one of {CATEGORY_LEVELS}")
    keep = reserve or 3 * p.result_size

    def tidy(batch_id: int) -> None:
        if not compact_every or not batch_id or batch_id % compact_every:
            return
        clock = t.clock.read(batch_id).agg(F.max("newest")).first()[0] or p.as_of
        day = _day(clock - p.retention_seconds)
        t.clock.tidy(lambda x: x.read().agg(F.max("newest").alias("newest")), batch_id, compact_every)
        t.late.tidy(lambda x: x.read().groupBy("day").agg(F.sum("n").alias("n")), batch_id, compact_every)
        t.events.tidy(lambda x: x.read().where(F.col("action_time") >= _reach(clock, p)), batch_id, compact_every)
        for table, key in ((t.items, ITEM_KEY), (t.pairs, PAIR_KEY)):
            table.tidy(lambda x, k=key: x.totals([*k, "day"], "tenths").where(F.col("day") >= day), batch_id, compact_every)
        t.lists.tidy(lambda x: x.latest(ranked.OWNER).where(F.col("item_id").isNotNull()), batch_id, compact_every)

    def write(batch: DataFrame, batch_id: int) -> None:
        tidy(batch_id)
        with scratch(t.events.spark):
            now = _Batch(t, batch_id, p, dim_item, level)
            now.count(*now.advance(batch))
            alive = lambda rows: ranked.still_listed(rows, dim_item, now.p)
            ranked.merge(t.lists, now.candidates(), batch_id, p.result_size, keep, alive, now.everything)

    return (
        history.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{p.flush_seconds} seconds"}))
        .start()
    )

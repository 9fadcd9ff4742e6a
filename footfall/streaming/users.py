"""Continuous lists per user: newest items and interest profiles, from bucketed tables.

Both keep what a list needs and no more: the newest ``recent_size`` items of a user form a list that merges in any
arrival order, and a profile is a sum per tag. A micro-batch shrinks to a few rows per user first, reads the lists or sums of its
users from their buckets and writes them anew; the merge is a window over both, and nothing is kept per key in a task.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators import content, ranking
from footfall.operators.enrich import enrich_items
from footfall.session import materialize, scratch
from footfall.sources.dimensions import latest_per
from footfall.streaming.keyed import BUCKETS, KeyedTable
from footfall.streaming.store import BatchTable, newest_rows

ENTRY = ["item_id", "action_type", "action_time", "seq", "platform", "lbs_info"]
ENTRY_SCHEMA = "item_id string, action_type int, action_time long, seq long, platform string, lbs_info string"
RECENT_SCHEMA = f"bid string, key string, rank int, {ENTRY_SCHEMA}"
PROFILE_SCHEMA = "bid string, user_id string, rank int, tag string, weight double, level int"
SUM_SCHEMA = "bid string, user_id string, tag string, tenths long, level int, put_at long"
UNIT = M.PROFILE_LEVEL * M.PROFILE_LOSS / 10.0
FOLD_EVERY = 16  # batches, where the job does not say


def recent_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(spark, path, RECENT_SCHEMA, ["key"], buckets)


def profile_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(spark, path, PROFILE_SCHEMA, ["bid", "user_id"], buckets)


# ---------------------------------------------------------------- newest items


def _merged(stored: DataFrame, fresh: DataFrame, size: int) -> DataFrame:
    """Lists of the newest items, of stored lists and new actions."""
    newest = [F.desc("action_time"), F.desc("seq")]
    items = latest_per(stored.select("bid", "key", *ENTRY).unionByName(fresh), ["bid", "key", "item_id"], newest)
    return ranking.top_n(items, ["bid", "key"], [*newest, F.asc("item_id")], size)


def start_user_recent(
    actions: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    p: Params,
    delay_seconds: int | None = None,
    trigger: dict | None = None,
    compact_every: int = 0,
) -> StreamingQuery:
    """Maintain the newest-items lists from a stream of resolved actions.

    Actions may come in any order, also more than ``delay_seconds`` late. Lists end ``p.recent_ttl_days`` after their newest action, by the
    newest action of earlier batches.
    """
    ttl = p.recent_ttl_days * M.DAY_SECONDS
    clock = BatchTable(table.spark, f"{table.path}/clock", "newest long, used long")

    def write(batch: DataFrame, batch_id: int) -> None:
        table.tidy(lambda t: t.latest(["key"]).where(F.col("rank") > 0), batch_id, compact_every)
        clock.tidy(lambda t: t.read().agg(F.max("newest").alias("newest"), F.max("used").alias("used")), batch_id, compact_every or FOLD_EVERY)
        with scratch(table.spark):
            maintain(batch, batch_id)

    def maintain(batch: DataFrame, batch_id: int) -> None:
        newest = [F.desc("action_time"), F.desc("seq")]
        fresh = latest_per(ranking.recent_rows(batch).select("bid", "key", *ENTRY), ["bid", "key", "item_id"], newest)
        fresh = materialize(fresh, "newest")
        now, used = (v or 0 for v in clock.read(batch_id).agg(F.max("newest"), F.max("used")).first())
        latest = fresh.agg(F.max("action_time")).first()[0]
        clock.append(clock.spark.createDataFrame([(max(now, latest or 0), now)], "newest long, used long"), batch_id)
        # Lists whose time was up since the last batch, by their first entries: newer entries of a list overrule older ones below.
        ending = table.read(batch_id).where((F.col("rank") == 1) & F.col("action_time").between(used - ttl + 1, now - ttl)).select("key")
        keys = materialize(fresh.select("key").unionByName(ending).distinct(), "keys")
        stored = newest_rows(table.lookup(keys, batch_id), ["key"]).where(F.col("rank") > 0)
        lists = _merged(stored, fresh, p.recent_size).withColumn("_newest", F.max("action_time").over(Window.partitionBy("bid", "key")))
        over = F.col("_newest") + ttl <= now
        entries = [F.when(~over, F.col(c)).otherwise(F.lit(0) if c in ("action_type", "action_time", "seq") else F.lit(None)).alias(c) for c in ENTRY]
        rows = lists.where(~over | (F.col("rank") == 1)).select("bid", "key", F.when(over, 0).otherwise(F.col("rank")).alias("rank"), *entries)
        table.append(rows, batch_id)

    return (
        actions.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{p.flush_seconds} seconds"}))
        .start()
    )


def served_recent(table: KeyedTable, dim_item: DataFrame, p: Params) -> DataFrame:
    """Lists alive at ``as_of`` with item attributes, in the columns of ``ranking.user_recent``."""
    rows = table.latest(["key"]).where(F.col("rank") > 0)
    newest = F.max("action_time").over(Window.partitionBy("key"))
    alive = rows.withColumn("_newest", newest).where(F.col("_newest") + p.recent_ttl_days * M.DAY_SECONDS > p.as_of)
    return ranking.recent_columns(enrich_items(alive.drop("_newest", "batch"), dim_item))


# ---------------------------------------------------------------- interest profiles


@dataclass
class ProfileTags:
    """Sums per tag, each with its own lifetime, and the best tags of users."""

    size: int
    ttl_ms: int

    def alive(self, sums: DataFrame, now_ms: int) -> DataFrame:
        return newest_rows(sums, ["bid", "user_id", "tag"]).where(F.col("put_at") > now_ms - self.ttl_ms)

    def summed(self, stored: DataFrame, fresh: DataFrame) -> DataFrame:
        """All sums of the users, and whether they are ``_new``."""
        columns = ["bid", "user_id", "tag", "tenths", "level"]
        rows = stored.select(*columns, F.lit(False).alias("_new")).unionByName(fresh.select(*columns, F.lit(True).alias("_new")))
        return rows.groupBy("bid", "user_id", "tag").agg(
            F.sum("tenths").alias("tenths"), F.min("level").alias("level"), F.max("_new").alias("_new")
        )

    def best(self, sums: DataFrame) -> DataFrame:
        ranked = ranking.top_n(sums, ["bid", "user_id"], [F.desc("tenths"), F.asc("tag")], self.size)
        return ranked.withColumn("weight", F.round(F.col("tenths") * F.lit(UNIT), 6))


def start_user_profile(
    actions: DataFrame,
    tags: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    p: Params,
    denied: Sequence[str] | DataFrame = (),
    override: Mapping[int, float] | DataFrame | None = None,
    trigger: dict | None = None,
    compact_every: int = 0,
) -> StreamingQuery:
    """Maintain the best tags of every user from a stream of resolved actions and a table of item tags.

    The full sums are stored beside the lists, so a tag that was out of the list comes back with all its weight. A tag that gets no
    weight for ``p.profile_ttl_days`` is forgotten.
    """
    user = ["bid", "user_id"]
    profile = ProfileTags(p.profile_size, p.profile_ttl_days * M.DAY_SECONDS * 1000)
    sums = KeyedTable(table.spark, f"{table.path}/sums", SUM_SCHEMA, user, table.buckets)
    tagged = content.drop_denied_tags(tags.select("bid", "item_id", "tag", "level").distinct(), denied)

    def write(batch: DataFrame, batch_id: int) -> None:
        now = int(time.time() * 1000)
        table.tidy(lambda t: t.latest(user), batch_id, compact_every)
        sums.tidy(lambda t: profile.alive(t.read(), now), batch_id, compact_every or FOLD_EVERY)
        with scratch(table.spark):
            maintain(batch, batch_id, now)

    def maintain(batch: DataFrame, batch_id: int, now: int) -> None:
        rows = batch.where(C.is_valid_user("user_id") & C.is_valid_item("item_id"))
        weighted = content.with_profile_weight(rows, override).where(F.col("_tenths") > 0).groupBy(*user, "item_id")
        items = weighted.agg(F.sum("_tenths").cast("long").alias("tenths"))
        fresh = items.join(tagged, ["bid", "item_id"]).groupBy(*user, "tag")
        fresh = materialize(fresh.agg(F.sum("tenths").alias("tenths"), F.min("level").alias("level")), "tag-sums")
        stored = profile.alive(sums.lookup(fresh.select(*user).distinct(), batch_id), now)
        after = materialize(profile.summed(stored, fresh), "profiles")
        sums.append(after.where("_new").withColumn("put_at", F.lit(now).cast("long")), batch_id)
        table.append(profile.best(after), batch_id)

    return (
        actions.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{p.flush_seconds} seconds"}))
        .start()
    )


def served_profiles(table: KeyedTable) -> DataFrame:
    return table.latest(["bid", "user_id"]).drop("batch").withColumn("type", F.lit(1))

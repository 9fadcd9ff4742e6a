"""Configuration tables that change while a job runs, and profiles that follow them.

Every change is a version of its own folder. The first attempt at a micro-batch pins the newest version of each table and
writes that down; a replay finds the pin and sees the same tables. So a change takes effect at the next batch and never in an
older one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators import content
from footfall.session import materialize, scratch
from footfall.sources import rules as R
from footfall.streaming.keyed import BUCKETS, KeyedTable
from footfall.streaming.store import BatchTable


class Setting:
    """One configuration table in versions 0, 1, 2, …, and the version that each micro-batch saw."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType):
        self.versions = BatchTable(spark, f"{path}/versions", schema)
        self.pins = BatchTable(spark, f"{path}/pins", "version long")

    def publish(self, rows: DataFrame) -> int:
        """Write a new version; it is there for batches that have not begun."""
        done = self.versions._layout()[1]
        version = done[-1] + 1 if done else 0
        self.versions.append(rows, version)
        return version

    def at(self, version: int) -> DataFrame:
        return self.versions._load("log", [version]).drop("batch") if version >= 0 else self.versions.read().drop("batch").limit(0)

    def pinned(self, batch_id: int) -> DataFrame:
        """The table as this micro-batch sees it, at its first attempt and at every other."""
        found = self.pins.read().where(F.col("batch") == batch_id).select("version").first()
        if found is None:
            done = self.versions._layout()[1]
            version = done[-1] if done else -1
            self.pins.append(self.pins.spark.createDataFrame([(version,)], "version long"), batch_id)
            return self.at(version)
        return self.at(found[0])


SUM_KEY = ["bid", "user_id", "tag"]
SUM_SCHEMA = "bid string, user_id string, tag string, level int, tenths long"
REJECT_SCHEMA = "seq long, bid string, topic string, reason string"


@dataclass
class Tables:
    rules: Setting  # rules.RULE_SCHEMA
    weights: Setting  # action_type int, weight double
    denied: Setting  # tag string
    sums: KeyedTable
    rejects: BatchTable


def tables(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Tables:
    return Tables(
        Setting(spark, f"{path}/rules", R.RULE_SCHEMA),
        Setting(spark, f"{path}/weights", "action_type int, weight double"),
        Setting(spark, f"{path}/denied", "tag string"),
        KeyedTable(spark, f"{path}/sums", SUM_SCHEMA, ["bid", "user_id"], buckets),
        BatchTable(spark, f"{path}/rejects", REJECT_SCHEMA),
    )


def _folded(sums: DataFrame) -> DataFrame:
    return sums.groupBy(*SUM_KEY).agg(F.min("level").alias("level"), F.sum("tenths").alias("tenths"))


def start_profiles(
    actions: DataFrame, tags: DataFrame, t: Tables, checkpoint: str, trigger: dict | None = None, compact_every: int = 0
) -> StreamingQuery:
    """Maintain interest sums from a stream of resolved actions under rules, weights and a deny list that may change.

    Actions that break a rule of their (bid, topic) go to ``rejects``; without any version of the rules all are accepted. An action counts
    with the weights and the deny list of its batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        t.sums.tidy(lambda x: _folded(x.read()), batch_id, compact_every)
        t.rejects.tidy(lambda x: x.read(), batch_id, compact_every)
        with scratch(t.sums.spark):
            maintain(materialize(batch, "batch"), batch_id)

    def maintain(batch: DataFrame, batch_id: int) -> None:
        config = R.rules_from_rows(t.rules.pinned(batch_id))
        if config.rules:
            batch = R.validate_rows(batch.withColumn("values", _values(batch, config)), config).drop("values")
        else:
            batch = batch.withColumn("reason", F.lit(None).cast("string"))
        t.rejects.append(batch.where(F.col("reason").isNotNull()).select("seq", "bid", "topic", "reason"), batch_id)
        rows = batch.where(F.col("reason").isNull() & C.is_valid_user("user_id") & C.is_valid_item("item_id"))
        weighted = content.with_profile_weight(rows, t.weights.pinned(batch_id)).where(F.col("_tenths") > 0)
        weighted = weighted.groupBy("bid", "user_id", "item_id").agg(F.sum("_tenths").alias("tenths"))
        tagged = content.drop_denied_tags(tags.select("bid", "item_id", "tag", "level").distinct(), t.denied.pinned(batch_id))
        t.sums.append(_folded(weighted.join(tagged, ["bid", "item_id"])), batch_id)

    return (
        actions.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def _values(rows: DataFrame, config: R.TopicRules):
    """The values of a row's topic in the order of the topic's fields; a field that is no column counts as missing."""
    out = F.array().cast("array<string>")
    for topic, fields in config.fields.items():
        own = [F.col(f).cast("string") if f in rows.columns else F.lit(None).cast("string") for f in fields]
        out = F.when(F.col("topic") == topic, F.array(*own)).otherwise(out)
    return out


def profiles(t: Tables, p: Params) -> DataFrame:
    """The best tags of every user in the columns of ``content.profile_top_tags``."""
    weight = F.round(F.col("tenths") * F.lit(content.M.PROFILE_LEVEL * content.M.PROFILE_LOSS / 10.0), 6)
    rows = _folded(t.sums.read()).select(*SUM_KEY, weight.alias("weight"), "level", F.lit(1).alias("type"))
    return content.profile_top_tags(rows, p)

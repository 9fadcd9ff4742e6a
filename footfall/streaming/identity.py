"""Identity inside the stream: actions that carry only a uid wait for the record that names their user.

Actions with a user pass at once. The others are looked up by uid in a bucketed table of the records so far: with a known user they
pass, else they go to a bucketed table of waiting actions, which they leave when the uid's record arrives, or as user "0"
once the newest action is ``wait_seconds`` younger. Everything is a join of a micro-batch with the buckets of its uids; nothing is
kept per key in a task. Groups are looked up in a table.

Resolved actions are Parquet files in one folder, from which the counting jobs read their stream. The files of a micro-batch are
written beside it and then moved into it one by one; a batch that runs again moves what is left and computes nothing anew, so every
action appears once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from footfall.functions import columns as C
from footfall.operators.identity import UNKNOWN_USER, resolve_group
from footfall.session import materialize, scratch
from footfall.streaming.keyed import BUCKETS, KeyedTable
from footfall.streaming.store import BatchTable

FOLD_EVERY = 16  # batches


class _Waiting:
    """The tables of a job, below the folder of its output, where readers of that folder do not look."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, wait_seconds: int, buckets: int):
        self.wait, self.columns = wait_seconds, schema.fieldNames()
        self.names = KeyedTable(spark, f"{path}/_identity/names", "uid string, user_id string", ["uid"], buckets)
        self.actions = KeyedTable(spark, f"{path}/_identity/waiting", schema, ["uid"], buckets)
        self.clock = BatchTable(spark, f"{path}/_identity/clock", "newest long, used long")

    def clocks(self, batch_id: int) -> tuple[int, int]:
        """The newest waiting or asking action of earlier batches, and the one that the batch before went by."""
        newest, used = self.clock.read(batch_id).agg(F.max("newest"), F.max("used")).first()
        return newest or 0, used or 0

    def tidy(self, batch_id: int) -> None:
        _, used = self.clocks(batch_id)
        self.clock.tidy(lambda t: t.read().agg(F.max("newest").alias("newest"), F.max("used").alias("used")), batch_id, FOLD_EVERY)
        self.names.tidy(lambda t: t.latest(["uid"]), batch_id, FOLD_EVERY)
        # What has left by its clock is not needed; actions whose user came stay until then.
        self.actions.tidy(lambda t: t.read().where(F.col("action_time") + self.wait > used), batch_id, FOLD_EVERY)

    def resolve(self, asking: DataFrame, records: DataFrame, batch_id: int) -> DataFrame:
        """Actions that leave in this batch, with their user."""
        newest, used = self.clocks(batch_id)
        order = F.struct("record_time", "user_id")
        self.names.append(records.groupBy("uid").agg(F.max_by("user_id", order).alias("user_id")), batch_id)
        latest = asking.agg(F.max("action_time")).first()[0]
        self.clock.append(self.clock.spark.createDataFrame([(max(newest, latest or 0), newest)], "newest long, used long"), batch_id)
        uids = asking.select("uid").unionByName(records.select("uid")).distinct()
        found = self.names.lookup(uids, batch_id + 1).groupBy("uid").agg(F.max_by("user_id", "batch").alias("_found"), F.min("batch").alias("_since"))
        found = materialize(found, "names")
        looked_up = materialize(asking.join(found, "uid", "left").withColumn("user_id", F.coalesce("_found", "user_id")), "looked-up")
        self.actions.append(looked_up.where(F.col("_found").isNull()), batch_id)
        # Who waits has no record in any earlier batch, so only uids that are new now can free them.
        held = self.actions.read(batch_id).where(F.col("action_time") + self.wait > used)
        freed = held.join(found.where(F.col("_since") == batch_id), "uid").withColumn("user_id", F.col("_found"))
        expired = held.where(F.col("action_time") + self.wait <= newest)
        known = self.names.read(batch_id + 1).select("uid")
        given_up = expired.join(known, "uid", "left_anti").withColumn("user_id", F.lit(UNKNOWN_USER))
        parts = [rows.select(*self.columns) for rows in (looked_up.where(F.col("_found").isNotNull()), freed, given_up)]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _publish(spark: SparkSession, path: str, batch_id: int, make) -> None:
    """Put the files of a batch into ``path``, each once, however often the batch runs."""
    jvm, name = spark._jvm, f"{path}/_staged/{batch_id}"
    folder = jvm.org.apache.hadoop.fs.Path(name)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{name}/_SUCCESS")):
        make().write.mode("overwrite").parquet(name)
    for status in fs.listStatus(folder):
        file = status.getPath()
        if file.getName().startswith("part-") and not fs.rename(file, jvm.org.apache.hadoop.fs.Path(f"{path}/{file.getName()}")):
            raise OSError(f"cannot move {file} to {path}")
    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/_staged/{batch_id - 1}"), True)


def start_identity(
    actions: DataFrame,
    records: DataFrame,
    group_map: DataFrame,
    path: str,
    checkpoint: str,
    wait_seconds: int,
    delay_seconds: int = 0,
    trigger: dict | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Write resolved actions (with ``group_id``) below ``path``.

    ``records`` is a stream of (uid, user_id, record_time); the newest record of a batch counts, and records without a valid user are passed
    over. Actions may come in any order, also more than ``delay_seconds`` late: none is left out. ``buckets`` must be the same at every start.
    """
    spark, columns, schema = actions.sparkSession, actions.columns, T.StructType([T.StructField(f.name, f.dataType) for f in actions.schema])
    waiting = _Waiting(spark, path, schema, wait_seconds, buckets)
    known = C.is_valid_user("user_id")
    usable_uid = F.coalesce((F.col("uid") != "") & (F.col("uid") != "0"), F.lit(False))
    named = records.select(
        *[F.col(c) if c in ("uid", "user_id") else F.lit(None).cast(actions.schema[c].dataType).alias(c) for c in columns],
        F.col("record_time").cast("long").alias("record_time"),
        F.lit(True).alias("is_record"),
    )
    both = actions.select(*columns, F.lit(None).cast("long").alias("record_time"), F.lit(False).alias("is_record")).unionByName(named)

    def resolved(batch: DataFrame, batch_id: int) -> DataFrame:
        acted = batch.where(~F.col("is_record")).select(*columns)
        asking = materialize(acted.where(~known & usable_uid), "asking")
        named = materialize(batch.where(F.col("is_record") & known).select("uid", "user_id", "record_time"), "records")
        return resolve_group(acted.where(known).unionByName(waiting.resolve(asking, named, batch_id)), group_map)

    def write(batch: DataFrame, batch_id: int) -> None:
        waiting.tidy(batch_id)
        with scratch(spark):
            _publish(spark, path, batch_id, lambda: resolved(batch, batch_id))

    return (
        both.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def resolved_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The output as a stream; ``schema`` is that of the actions, to which ``group_id`` is added."""
    return spark.readStream.schema(T.StructType([*schema.fields, T.StructField("group_id", T.StringType())])).parquet(path)

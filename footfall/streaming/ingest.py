"""Continuous ingest of action messages, accepted rows and rejects in one write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from footfall import model as M
from footfall.sources import messages as msg
from footfall.streaming.store import BatchTable


def parsed_table(spark: SparkSession, path: str) -> BatchTable:
    extra = [T.StructField("line", T.StringType()), T.StructField("reason", T.StringType())]
    return BatchTable(spark, path, T.StructType([*M.ACTION_SCHEMA.fields, *extra]))


def start_ingest(
    messages: DataFrame,
    table: BatchTable,
    checkpoint: str,
    profile: str = "general",
    separator: str = msg.DEFAULT_SEPARATOR,
    trigger: dict | None = None,
    compact_every: int = 0,
) -> StreamingQuery:
    """Parse a message stream into ``table``. Accepted rows have no ``reason``; rejects
    have one and keep their text (accepted rows do not)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.tidy(lambda t: t.read(), batch_id, compact_every)
        text = F.when(F.col("reason").isNotNull(), F.col("line"))
        table.append(msg.parse_actions(batch, profile, separator).withColumn("line", text), batch_id)

    return (
        messages.select("seq", "attr", "line")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def accepted(table: BatchTable) -> DataFrame:
    return msg.accepted(table.read().drop("batch"))


def rejected(table: BatchTable) -> DataFrame:
    return msg.rejected(table.read())


def verdict_counts(table: BatchTable) -> DataFrame:
    verdict = F.coalesce(F.col("reason"), F.col("topic"))
    return table.read().groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))

"""Ranks over a whole table without a single task that sees it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within the task in its low bits


def ranked(rows: DataFrame, order: Sequence[Column], name: str, purpose: str) -> DataFrame:
    """``rows`` with their rank from 1 in ``order``: ranges are sorted apart and shifted by the ranges before.

    The sorted rows are written once, so the place of a row is fixed. Only one number per range meets in one task.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed, purpose)
    part = F.shiftright("_at", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    out = placed.withColumn("_part", part).join(firsts, "_part")
    return out.withColumn(name, (F.col("_first") + within + 1).cast("long")).drop("_part", "_at", "_first")

"""Mixing sources to target weights by pivotal dependent rounding.

1. Sources in code point order (null last) get the weights 1, 2, 3, repeating; their targets share all words, none above
   ``MOST`` times its source: the level at which ``sum(min(most * size, level * weight))`` is the whole is found by capping, round
   after round, the sources above it.
2. Each document of a source should be copied target / source size times: the whole part is certain, the fraction is a probability.
3. Fractions are rounded in pairs: two documents of a source exchange probable words until one of them is in or out,
   at random so that no document's expectation changes; the pair's words stay the same. A leaf of a source keeps one open document,
   leaves meet ``FAN`` at a time until one is left per source, which is drawn by its probability. Documents
   come by descending size, so the open one ends up small and a source misses its target by a small document at most.

Every draw comes from a generator seeded by (seed, level, source, leaf), so reruns agree.

Defined results: a null or empty text has size 0 and takes nothing; a null source is a source of its own; rows that share a
doc_id, also a null one, are documents each, and equal rows are interchangeable; a source without words has target 0; an empty table gives no
rows. A long text is counted whole. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from footfall.llm.ranks import ranked
from footfall.llm.words import slices, word_bounds
from footfall.session import materialize

WEIGHTS = (1, 2, 3)
SHARE = 1.0
MOST = 3
SEED = 11
LEAF_ROWS = 4096
FAN = 64
EPSILON = 1e-9


@F.arrow_udf(T.LongType())
def _word_count(text: pa.Array) -> pa.Array:
    counts = []
    for _, _, data, offsets in slices(text):
        starts, _ = word_bounds(data, offsets)
        counts.append(np.diff(np.searchsorted(starts, offsets)))
    return pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, rows, target, base, fraction of every source of (source, size)."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sources = ranked(sources, [F.col("source").asc_nulls_last()], "rank", "mix-sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = materialize(sources.withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int"))), "mix-sources")
    cap = F.col("source_size") * most
    capped, stopped, level = F.lit(False), -1, (0.0, 1.0)
    while True:
        words, at_cap, weight, n = sources.agg(
            F.sum("source_size"), F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight"))), F.count_if(capped)
        ).first()
        if n == stopped or not weight:
            break
        stopped, level = n, (share * words - (at_cap or 0), weight)
        capped = F.col("weight") * F.lit(level[0]) / F.lit(level[1]) >= cap
    target = F.when(capped, cap.cast("double")).otherwise(F.col("weight") * F.lit(level[0]) / F.lit(level[1]))
    copies = F.when(capped, F.lit(float(most))).otherwise(target / F.col("source_size"))
    return sources.select(
        "source", "source_size", "rows", target.alias("target"), F.when(F.col("source_size") > 0, copies).otherwise(0.0).alias("_copies")
    ).select(
        "source", "source_size", "rows", "target", F.floor("_copies").alias("base"), (F.col("_copies") - F.floor("_copies")).alias("fraction")
    )


def _round(batches: Iterator[pa.RecordBatch], seed: int, level: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows (source, leaf, doc_id, size, words), sorted by source and leaf: ``extra`` is 1 or 0 where the row is decided.

    ``words`` is the probable number of words, between 0 and size. Of each leaf one row at most stays open (null).
    """
    key, held, draw, names = None, None, None, None

    def settle(row):
        _, _, _, size, words = row
        return 0 if words <= EPSILON * size else 1 if words >= size * (1 - EPSILON) else None

    def close(row):
        row = tuple(row)
        done = settle(row)
        return (*row, int(draw.random() * row[3] < row[4]) if done is None and last else done)

    for batch in batches:
        names, out = batch.schema, []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:2] != key:
                if held is not None:
                    out.append(close(held))
                key, held, draw = row[:2], None, Random(f"{seed}:{level}:{row[0]!r}:{row[1]}")
            if held is None:
                held = row
                continue
            (*_, n, x), (*_, m, y) = held, row
            up, down = min(n - x, y), min(x, m - y)  # words the held row can get from the other, and give to it
            move = up if draw.random() * (up + down) < down else -down
            pair = ((*held[:4], x + move), (*row[:4], y - move))
            states = [settle(p) for p in pair]
            open_rows = [p for p, s in zip(pair, states, strict=True) if s is None]
            out.extend((*p, s) for p, s in zip(pair, states, strict=True) if s is not None)
            held = open_rows[0] if open_rows else None
        yield _batch(out, names)
    if held is not None:
        yield _batch([close(held)], names)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    kinds = [*schema.types, pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*schema.names, "extra"])


def pivotal(rows: DataFrame, most_leaves: int, seed: int = SEED, fan: int = FAN) -> list[DataFrame]:
    """Tables whose union has every row of (source, leaf, doc_id, size, words) with its ``extra`` copy, 0 or 1."""
    kind = f"{rows._jdf.schema().toDDL()}, extra INT"
    levels, parts = math.ceil(math.log(max(1, most_leaves), fan) - 1e-12), []
    for level in range(levels + 1):
        ordered = rows.repartition("source", "leaf").sortWithinPartitions(
            "source", "leaf", F.desc("size"), F.xxhash64("doc_id", F.lit(seed)), "doc_id", "words"
        )
        done = materialize(ordered.mapInArrow(lambda b, n=level: _round(b, seed, n, n == levels), kind), "mix-level")
        parts.append(done.where(F.col("extra").isNotNull()))
        rows = done.where(F.col("extra").isNull()).drop("extra").withColumn("leaf", F.floor(F.col("leaf") / fan))
    return parts


def plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED, leaf_rows: int = LEAF_ROWS, fan: int = FAN
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every document."""
    sized = materialize(docs.select("doc_id", "source", _word_count("text").alias("size")), "mix-sizes")
    per = materialize(targets(sized, weights, share, most), "mix-targets")
    known = sized.join(per.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    is_open = (F.col("size") > 0) & (F.col("fraction") > EPSILON) & (F.col("fraction") < 1 - EPSILON)
    # A fraction that floating point left just below 1 is a copy.
    sure = known.where(~is_open).select("doc_id", "source", "size", F.when(F.col("fraction") >= 1 - EPSILON, 1).otherwise(0).alias("extra"))
    leaves = F.ceil(F.col("rows") / leaf_rows)
    words = (F.col("size") * F.col("fraction")).alias("words")
    leaf = F.pmod(F.xxhash64("doc_id", "size"), leaves).alias("leaf")
    most_leaves = per.agg(F.max(leaves)).first()[0] or 1
    for part in pivotal(known.where(is_open).select("source", leaf, "doc_id", "size", words), most_leaves, seed, fan):
        sure = sure.unionByName(part.select("doc_id", "source", "size", "extra"))
    out = sure.join(per.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    copies = F.least(F.col("base") + F.col("extra"), F.lit(most)).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns, and the number of copies."""
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the plan copies it."""
    key = ["doc_id", "source", "__size"]
    numbered = docs.withColumn("__size", _word_count("text"))
    numbered = numbered.withColumn("__nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("text"))))
    copies = plan(docs, **options).withColumnRenamed("size", "__size")
    copies = copies.withColumn("__nth", F.row_number().over(Window.partitionBy(*key).orderBy("copies"))).where(F.col("copies") > 0)
    left, right = numbered.alias("l"), copies.select(*key, "__nth", "copies").alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*key, "__nth")]
    joined = left.join(right, same).select("l.*", F.explode(F.sequence(F.lit(1), F.col("r.copies").cast("int"))).alias("__copy"))
    return joined.select(*[joined[c] for c in docs.columns])

"""Sharding by extendible hashing.

The directory is indexed by leading bits of a key hash. It starts with one bucket, and
only buckets above the byte limit split on one more bit, so shards have different depths
and every one fits its limit.

Bytes are first summed per leaf (a prefix deep enough that a leaf is a small part of a
shard), once for all depths; the splits are then worked out on that small table. Leaves
still too large go round again with more bits.

Defined results: a null text has 0 bytes, a null key hashes as the empty string. A row larger than
the limit cannot fit and gets a shard of its own (kind "row"), also where its key is repeated: ``piece`` numbers them. Rows whose keys hash alike and together
exceed the limit, such as one key repeated very often, are cut by size class and count
(kind "key"), the rows of equal key and size being interchangeable. An empty table gives no rows.
Other columns of the input are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.session import materialize

BITS = 60
LIMIT_BYTES = 16 << 20


def key_hash(key: Column) -> Column:
    """60 bits of the key's MD5: the same in every engine."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")


def assign(docs: DataFrame, limit: int = LIMIT_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key, bytes and shard: (key, n_bytes, kind, depth, prefix, piece).

    ``kind`` "hash" is a bucket of the directory: ``prefix`` holds its ``depth`` leading bits.
    """
    rows = docs.select(
        F.col(key).alias(key),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("_b"),
        key_hash(F.col(key)).alias("_h"),
    )
    rows = materialize(rows, "shard-rows")  # ids and sizes only: the texts are read once
    large = _single(rows.where(F.col("_b") > limit), key)
    rows = rows.where(F.col("_b") <= limit)
    heavy = rows.groupBy("_h").agg(F.sum("_b").alias("_s")).where(F.col("_s") > limit).select("_h")
    heavy = materialize(heavy, "shard-heavy")
    alike = _pieces(rows.join(heavy, "_h", "left_semi"), limit, key)
    rest = rows.join(heavy, "_h", "left_anti")
    directory = _directory(rest, limit)
    placed = []
    for bits, leaves in directory:
        leaf = F.shiftright("_h", BITS - bits)
        placed.append(
            rest.withColumn("_leaf", leaf)
            .join(leaves, "_leaf")
            .select(
                key, F.col("_b").alias("n_bytes"), F.lit("hash").alias("kind"), F.col("_depth").alias("depth"),
                F.when(F.col("_depth") == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftright(_h, {BITS} - _depth)")).alias("prefix"),
                F.lit(0).cast("long").alias("piece"),
            )
        )
    out = large.unionByName(alike)
    for part in placed:
        out = out.unionByName(part)
    return out


def _directory(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """(bits, table of _leaf and _depth) per round; every leaf appears in exactly one round."""
    total = rows.agg(F.sum("_b")).first()[0] or 0
    bits = min(BITS, max(1, (max(1, total // limit)).bit_length() + 5))
    rounds, todo = [], rows
    while True:
        leaves = materialize(todo.groupBy(F.shiftright("_h", BITS - bits).alias("_leaf")).agg(F.sum("_b").alias("_b")), "shard-leaves")
        above = leaves.select("_leaf", "_b", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("_d"))
        node = F.expr(f"shiftright(_leaf, {bits} - _d)").alias("_node")
        full = above.groupBy("_d", node).agg(F.sum("_b").alias("_s")).where(F.col("_s") > limit).select("_d", "_node")
        # A bucket above the limit has only such buckets above it, so the deepest one decides.
        deepest = (
            above.withColumn("_node", F.expr(f"shiftright(_leaf, {bits} - _d)"))
            .join(full, ["_d", "_node"], "left_semi")
            .groupBy("_leaf")
            .agg((F.max("_d") + 1).alias("_depth"))
        )
        depth = materialize(leaves.select("_leaf").join(deepest, "_leaf", "left").select("_leaf", F.coalesce("_depth", F.lit(0)).alias("_depth")), "shard-depths")
        rounds.append((bits, depth.where(F.col("_depth") <= bits)))
        over = depth.where(F.col("_depth") > bits).select("_leaf")
        if over.isEmpty():
            return rounds
        todo = todo.withColumn("_leaf", F.shiftright("_h", BITS - bits)).join(over, "_leaf", "left_semi").drop("_leaf")
        bits = min(BITS, bits + 6)


def _single(rows: DataFrame, key: str) -> DataFrame:
    """A shard for every row, numbered within its hash: equal rows are counted and the counts expanded, not the rows gathered."""
    same = rows.groupBy("_h", key, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_h").orderBy(key, "_b").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long"))
    numbered = same.withColumn("_first", first).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return numbered.select(
        key, F.col("_b").alias("n_bytes"), F.lit("row").alias("kind"), F.lit(BITS).alias("depth"), F.col("_h").alias("prefix"),
        (F.col("_first") + F.col("_k")).alias("piece"),
    )


def _pieces(rows: DataFrame, limit: int, key: str) -> DataFrame:
    """Rows with one hash: as many of a size together as fit; counts are split, not rows gathered."""
    same = rows.groupBy("_h", key, "_b").agg(F.count("*").alias("_n"))
    fit = F.when(F.col("_b") == 0, F.col("_n")).otherwise(F.greatest(F.lit(1).cast("long"), F.expr(f"{limit} div _b")))
    cut = same.withColumn("_fit", fit).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(_n - 1) div _fit"))))
    here = F.least(F.col("_fit"), F.col("_n") - F.col("_i") * F.col("_fit"))
    # The piece number carries the size and the key too: different sizes never share a piece.
    piece = F.xxhash64(key, "_b", "_i")
    return (
        cut.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), here)))
        .select(key, F.col("_b").alias("n_bytes"), F.lit("key").alias("kind"), F.lit(BITS).alias("depth"), F.col("_h").alias("prefix"), piece.alias("piece"))
    )

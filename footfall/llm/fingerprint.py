"""Document fingerprints: one-permutation MinHash with optimal densification.

Every word shingle is hashed once. The leading bits of the hash name a bin, and each of the
``BINS`` bins keeps its smallest hash. An empty bin borrows the value of the full bin that comes
first in its own fixed pseudo-random order, so texts with the same full bins borrow alike. The low
``LOW_BITS`` bits of every bin are stored, packed as hex. Two fingerprints agree in a bin by
chance with probability 2**-LOW_BITS, which the likeness takes off.

All of it is column expressions: no shuffle, no Python on the executors.

Words are runs of characters other than space and 0x09-0x0D, in lower case; a text of fewer than
``SHINGLE_WORDS`` words is one shingle. Defined results: a null text is an empty one; a text without words has the empty fingerprint,
which is like another empty one (1.0) and unlike all others (0.0). Repeated rows are fingerprinted each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.session import materialize

SHINGLE_WORDS = 5
BINS = 256
BIN_BITS = 8
LOW_BITS = 8
TRIES = 8
ROWS_PER_BUCKET = 4000
MOST_BUCKETS = 4096


def _words(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(words: str) -> Column:
    w, n = F.col(words), F.size(words)
    many = F.transform(
        F.sequence(F.lit(0), n - SHINGLE_WORDS), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE_WORDS)])
    )
    few = F.array(F.aggregate(w, F.size(words).cast("long"), lambda s, x: F.xxhash64(s, x)))
    return F.when(n >= SHINGLE_WORDS, many).when(n > 0, few).otherwise(F.array().cast("array<bigint>"))


def _bin(x: Column) -> Column:
    # Arrays are sorted as signed numbers, so the bin must grow with the signed value.
    return F.shiftright(x, 64 - BIN_BITS) + BINS // 2


def _starts_bin(grams: Column):
    return lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(grams, i - 1)))


def _with_gap(least: Column):
    """A value preceded by a null for every empty bin since the one before it."""

    def placed(x: Column, i: Column) -> Column:
        before = F.when(i > 0, _bin(F.get(least, i - 1))).otherwise(-1)
        return F.concat(F.array_repeat(F.lit(None).cast("long"), (_bin(x) - before - 1).cast("int")), F.array(x))

    return placed


def _stored(dense: Column, least: Column):
    """The stored digits of a bin. The full bin that lends to an empty one is the first in the bin's own
    random order: TRIES places are looked up, and only if all are empty is the rest of the order searched."""

    def digits(x: Column, i: Column) -> Column:
        tries = [F.get(dense, F.pmod(F.xxhash64(i, F.lit(a)), F.lit(BINS)).cast("int")) for a in range(TRIES)]
        rest = F.array_min(F.transform(least, lambda y: F.struct(F.xxhash64(i, _bin(y)).alias("o"), y.alias("v"))))["v"]
        value = F.coalesce(x, *tries, rest)
        return F.lpad(F.lower(F.hex(value.bitwiseAND((1 << LOW_BITS) - 1))), LOW_BITS // 4, "0")

    return digits


def fingerprints(docs: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Add a fingerprint column (hex string) for each text column: {new column: text column}."""
    out = docs
    for k, (name, text) in enumerate(texts.items()):
        words, grams, least, dense = (f"_fp{k}_{x}" for x in ("words", "grams", "least", "dense"))
        out = out.withColumn(words, _words(F.col(text)))
        out = out.withColumn(grams, F.sort_array(_grams(words)))
        out = out.withColumn(least, F.filter(grams, _starts_bin(F.col(grams))))
        tail = F.array_repeat(F.lit(None).cast("long"), (BINS - 1 - _bin(F.get(F.col(least), F.size(least) - 1))).cast("int"))
        filled = F.concat(F.flatten(F.transform(least, _with_gap(F.col(least)))), tail)
        out = out.withColumn(dense, F.when(F.size(least) > 0, filled))
        packed = F.array_join(F.transform(dense, _stored(F.col(dense), F.col(least))), "")
        out = out.withColumn(name, F.coalesce(packed, F.lit(""))).drop(words, grams, least, dense)
    return out


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1."""
    digits = LOW_BITS // 4
    pairs = F.zip_with(F.regexp_extract_all(a, F.lit(f"(.{{{digits}}})"), 1), F.regexp_extract_all(b, F.lit(f"(.{{{digits}}})"), 1), lambda x, y: x == y)
    agree = F.size(F.filter(pairs, lambda x: x)) / F.lit(float(BINS))
    chance = 2.0**-LOW_BITS
    estimate = F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(estimate)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, digest, next_key, next_text): the document that follows in descending key order, cyclically.

    Of rows that share a key, the next text is the one with the greatest MD5 (``digest``); a null key
    follows nothing, has an empty next text and is not next to anything. Documents are dealt into key ranges, and the document
    at the end of a range is copied to the range above, so that a window never leaves its range
    and whole texts are shuffled once.
    """
    rows = docs.select(F.col(key).alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("_t")).withColumn("_m", F.md5("_t"))
    kind = rows.schema["_k"].dataType
    loose = rows.where(F.col("_k").isNull()).select(
        F.lit(None).cast(kind).alias(key), F.col("_t").alias(text), F.col("_m").alias("digest"),
        F.lit(None).cast(kind).alias("next_key"), F.lit("").alias("next_text"),
    )
    least, borders = _borders(rows)
    if not borders:
        return loose
    edge = F.array(*[F.lit(b) for b in borders])

    def middle(s: Column) -> Column:
        return F.shiftright(s["lo"] + s["hi"], 1)

    # Binary search for the first border at or above the key.
    at = F.aggregate(
        F.sequence(F.lit(1), F.lit(max(1, len(borders).bit_length()))),
        F.struct(F.lit(0).alias("lo"), F.lit(len(borders) - 1).alias("hi")),
        lambda s, _: F.struct(
            F.when(F.get(edge, middle(s)) >= F.col("_k"), s["lo"]).otherwise(F.least(middle(s) + 1, s["hi"])).alias("lo"),
            F.when(F.get(edge, middle(s)) >= F.col("_k"), middle(s)).otherwise(s["hi"]).alias("hi"),
        ),
    )["lo"]
    placed = rows.where(F.col("_k").isNotNull()).withColumn("_at", at)
    own = F.struct(F.col("_at").alias("b"), F.lit(False).alias("copy"), F.col("_k").alias("o"))
    top = F.col("_at") == len(borders) - 1
    copy = F.struct(
        F.when(top, F.lit(0)).otherwise(F.col("_at") + 1).alias("b"), F.lit(True).alias("copy"),
        F.when(top, F.lit(least - 1).cast(kind)).otherwise(F.col("_k")).alias("o"),
    )
    copies = F.when(F.get(edge, F.col("_at")) == F.col("_k"), F.array(own, copy)).otherwise(F.array(own))
    spread = placed.withColumn("_c", F.explode(copies)).select("_k", "_t", "_m", "_c.b", "_c.copy", "_c.o")
    below = Window.partitionBy("b").orderBy("o").rangeBetween(Window.unboundedPreceding, -1)
    after = spread.withColumn("_n", F.max(F.struct("o", "_m", "_k", "_t")).over(below)).where(~F.col("copy"))
    return after.select(
        F.col("_k").alias(key), F.col("_t").alias(text), F.col("_m").alias("digest"),
        F.col("_n._k").alias("next_key"), F.col("_n._t").alias("next_text"),
    ).unionByName(loose)


def _borders(rows: DataFrame) -> tuple[int | None, list[int]]:
    """The smallest key, and sorted keys that end the ranges; the largest key is always the last."""
    n, least, most = rows.agg(F.count("_k"), F.min("_k"), F.max("_k")).first()
    parts = max(1, min(MOST_BUCKETS, n // ROWS_PER_BUCKET))
    found = []
    if parts > 1:
        found = rows.agg(F.percentile_approx("_k", [i / parts for i in range(1, parts)], 10 * parts)).first()[0]
    return least, sorted({*found, most}) if n else []


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last half replaced by as much of the start of the next text."""
    n = F.char_length(text)
    return F.concat(F.substring(text, 1, n - F.floor(n / 2).cast("int")), F.substring(next_text, 1, F.floor(n / 2).cast("int")))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint and that of its edited text, with their likeness to each other and
    to the next document's: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document's fingerprint is read from its own row, by key. A null doc_id has near_next 0.
    """
    rows = with_next(docs).withColumn("_edited", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    printed = fingerprints(rows, {"fingerprint": "text", "edited_fingerprint": "_edited"}).select(
        "doc_id", "digest", "next_key", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
    )
    printed = materialize(printed, "fingerprints")
    of_next = printed.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("next_key"))
    of_next = of_next.agg(F.max(F.struct("digest", "fingerprint"))["fingerprint"].alias("_next"))
    return printed.join(of_next, "next_key", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        F.coalesce(likeness(F.col("fingerprint"), F.col("_next")), F.lit(0.0)).alias("near_next"),
    )

"""Benchmark decontamination by spaced-seed hashing.

Texts are compared as words: maximal runs of letters and digits, in lower case; in scripts that are written without spaces every
character is a word. A document is contaminated by an item when, on one alignment, some ``WINDOW`` consecutive words of the item agree
with the document in all but ``SUBSTITUTIONS`` places. A shorter item is one window of its own length, with one substitution from
``ONE_FROM`` words on and none below: an item of one to four words contaminates every document that has just this sequence.
An item without words contaminates nothing.

Each mask hashes five words at fixed distances and ignores the places between, so a substitution
there does no harm. The two masks are lossless for these limits: every agreeing window has a hit of one of them (the tests
go through all substitution patterns). Item seeds are joined with document seeds by hash; every hit
names an alignment, and alignments are then compared word by word. An item that is shorter than the masks has its
whole sequence as its one seed; documents are searched for such seeds of the lengths that occur.

All of it is column expressions. Defined results: null texts are empty; rows are told apart by 128 bits of id and
text, so repeated or null ids are safe; long texts are searched whole; a result row names doc_id and item_id once. Empty tables give no
rows. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from footfall.session import materialize

WINDOW = 15
SUBSTITUTIONS = 3
ONE_FROM = 8
MASKS = ((0, 1, 2, 4, 5), (0, 1, 2, 3, 4))
#: Item seeds up to this number (some 100 MB in memory) are sent to every executor; more are joined by a shuffle.
MOST_BROADCAST = 2_000_000


# Scripts written without spaces.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def words(text: Column) -> Column:
    lower = F.lower(F.coalesce(text, F.lit("")))
    apart = F.when(F.octet_length(lower) == F.char_length(lower), lower).otherwise(F.regexp_replace(lower, UNSPACED, " $0 "))
    return F.array_remove(F.split(apart, r"[^\p{L}\p{N}]+"), "")


def _seeds(hashes: Column, mask: tuple[int, ...]) -> Column:
    n = F.size(hashes) - max(mask)
    found = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(hashes, i + o) for o in mask]))
    return F.when(n > 0, found).otherwise(F.array().cast("array<bigint>"))


def _document_seeds(rows: DataFrame) -> DataFrame:
    """(_row, seed, _at): words are split and hashed once; seeds of mask k at word i stand at place i * masks + k."""
    hashed = rows.select("_row", F.transform(words(F.col("_text")), lambda w: F.xxhash64(w)).alias("_h"))
    per_mask = [_seeds(F.col("_h"), mask) for mask in MASKS]
    spread = hashed.select("_row", *[s.alias(f"_s{k}") for k, s in enumerate(per_mask)])
    spread = spread.select("_row", F.concat(*[f"_s{k}" for k in range(len(MASKS))]).alias("_s"), F.size("_s0").alias("_n"))
    # An inner explode would have its "not empty" filter pushed below, computing all of this per element.
    return spread.select("_row", "_n", F.posexplode_outer("_s").alias("_i", "seed"))


def identified(docs: DataFrame) -> DataFrame:
    """The documents with ``_row``, 128 bits of hash of id and text (in place of a column of that name)."""
    return docs.withColumn("_row", row_hash(docs["doc_id"], docs["text"]))


def row_hash(doc_id: Column, text: Column) -> Column:
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.xxhash64(F.lit(1), text, doc_id).alias("b"))


def _whole_items(rows: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """Alignments of items of ``n`` words with the places of documents that hash like the whole item."""
    mask = tuple(range(n))
    asked = items.select("_item", F.get(_seeds(F.transform("_w", lambda w: F.xxhash64(w)), mask), F.lit(0)).alias("seed"))
    hashed = rows.select("_row", F.transform(words(F.col("_text")), lambda w: F.xxhash64(w)).alias("_h"))
    found = hashed.select("_row", _seeds(F.col("_h"), mask).alias("_s")).select("_row", F.posexplode_outer("_s").alias("_shift", "seed"))
    return found.join(asked, "seed").select("_row", "_item", "_shift")


def allowed(n: Column) -> Column:
    return F.when(n >= WINDOW, SUBSTITUTIONS).when(n >= ONE_FROM, 1).otherwise(0)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """_row, doc_id, item_id, n_words (of the window), n_equal, start (word of the document), for every contaminated pair.

    Of several windows the one with most equal words is named, then the first.
    """
    items = materialize(
        benchmark.select("item_id", words(F.col("text")).alias("_w"))
        .where(F.size("_w") > 0)
        .distinct()
        .select(F.xxhash64("item_id", "_w").alias("_item"), "item_id", "_w"),
        "benchmark-items",
    )
    rows = identified(docs.select("doc_id", "text")).select("_row", "doc_id", F.col("text").alias("_text"))
    least = len(MASKS[0])
    long, of_items = items.where(F.size("_w") >= least), None
    for k, mask in enumerate(MASKS):
        hashed = long.select("_item", F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
        part = hashed.select("_item", F.lit(k).alias("_mask"), F.posexplode_outer(_seeds(F.col("_h"), mask)).alias("_there", "seed"))
        of_items = part if of_items is None else of_items.unionByName(part)
    of_items = materialize(of_items, "benchmark-seeds")
    if of_items.count() <= MOST_BROADCAST:
        of_items = F.broadcast(of_items)
    hits = _document_seeds(rows).join(of_items, "seed")  # rows of texts without seeds have none to join
    first = F.col("_n")
    hits = hits.select(
        "_row", "_item",
        F.when(F.col("_i") < first, 0).otherwise(1).alias("_k"), "_mask", "_there",
        F.when(F.col("_i") < first, F.col("_i")).otherwise(F.col("_i") - first).alias("_here"),
    ).where(F.col("_k") == F.col("_mask"))
    lines = hits.select("_row", "_item", (F.col("_here") - F.col("_there")).alias("_shift"))
    for (n,) in sorted(items.where(F.size("_w") < least).select(F.size("_w")).distinct().collect()):  # 4 lengths at most
        lines = lines.unionByName(_whole_items(rows, items.where(F.size("_w") == n), n))
    lines = materialize(lines.distinct(), "benchmark-hits")

    aligned = rows.join(lines, "_row").join(items, "_item")
    aligned = aligned.select("_row", "doc_id", "item_id", "_shift", "_w", words(F.col("_text")).alias("_d"))
    size = F.size("_w")
    # 1 where the words agree, along the item; a place outside the document disagrees. The column of words is
    # named twice, so that it is computed once per row and not moved into the lambda.
    def agrees(w: Column, q: Column) -> Column:
        at = F.col("_shift") + q
        return F.when((at >= 0) & (at < F.size("_d")), (F.get(F.col("_d"), F.greatest(at, F.lit(0))) == w).cast("int")).otherwise(0)

    equal = F.transform(F.col("_w"), agrees)
    aligned = aligned.select("_row", "doc_id", "item_id", "_shift", equal.alias("_e"), F.least(size, F.lit(WINDOW)).alias("n_words"), allowed(size).alias("_most"))
    totals = F.transform(
        F.sequence(F.lit(0), F.size("_e") - F.col("n_words")),
        lambda s: F.struct(
            F.aggregate(F.slice(F.col("_e"), s + 1, F.col("n_words")), F.lit(0), lambda a, x: a + x).alias("n_equal"),
            (-(F.col("_shift") + s)).alias("_back"),
        ),
    )
    # Written before it is filtered: a filter would be pushed below the join, with all of the above inside it.
    scored = aligned.select("_row", "doc_id", "item_id", "n_words", "_most", F.array_max(totals).alias("_b"))
    best = materialize(scored, "benchmark-overlaps").where(F.col("_b.n_equal") >= F.col("n_words") - F.col("_most"))
    return best.groupBy("_row", "doc_id", "item_id", "n_words").agg(F.max("_b").alias("_b")).select(
        "_row", "doc_id", "item_id", F.col("n_words").cast("long").alias("n_words"),
        F.col("_b.n_equal").cast("long").alias("n_equal"), (-F.col("_b._back")).cast("long").alias("start"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words, n_equal, start: one row for a pair."""
    return overlaps(docs, benchmark).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_equal", (-F.col("start")).alias("back"), "n_words")).alias("_b")
    ).select("doc_id", "item_id", F.col("_b.n_words").alias("n_words"), F.col("_b.n_equal").alias("n_equal"), (-F.col("_b.back")).alias("start"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without contaminated rows; columns as they are."""
    found = overlaps(docs, benchmark).select(F.col("_row").alias("_contaminated_row")).distinct()
    return docs.join(found, row_hash(docs["doc_id"], docs["text"]) == found["_contaminated_row"], "left_anti")

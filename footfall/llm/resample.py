"""Target-distribution importance resampling with an exact distributed cutoff.

1. Features are runs of 1 to ``GRAM`` consecutive words, hashed to ``BUCKETS`` buckets by crc32. Their counts in all documents and in
   the target texts are two arrays of that size; a bucket's gain is the scaled logarithm of their smoothed ratio.
2. Each document is scored from the array of gains: the floored mean over its features, plus Gumbel noise from a hash
   of its id, so the highest scores are a draw without replacement by weight.
3. The last drawn key (score down, doc_id up) is found by weighted median-of-medians: chunks of ``CHUNK`` remaining keys give their median, the
   median of those, weighted by the chunk sizes, has at least a quarter of the keys on either side, and the side
   without the cutoff is discarded, until few keys remain. Keys are written anew whenever a quarter of those written is left.
4. The winners are sorted by ranges. No key but medians and the last ``FEW`` comes to the driver.

Defined results: a null or empty text has no features and weight 0; a null doc_id counts as an empty one in the noise and comes last among
equal scores; rows that share a doc_id are drawn each; long texts are read whole, in pieces; with an empty target all gains
follow the formula with T = 0; an empty table gives no rows. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.ranks import ranked
from footfall.llm.terms import term_pieces
from footfall.session import materialize

GRAM = 1
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
CHUNK = 1 << 16
FEW = 4096
LAST_ID = (1 << 63) - 1
# Written scores are 64-bit; keys are compared as (-score, id).


def _buckets(column: pa.Array, gram: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every feature, a piece of text at a time. Runs of several words may span pieces of a long text."""
    tail_row, tail = -1, []
    for row, terms in term_pieces(column):
        if gram == 1:
            coded = terms.dictionary_encode()
            known = np.array([zlib.crc32(w.encode()) % buckets for w in coded.dictionary.to_pylist()], np.int64)
            yield row, known[coded.indices.to_numpy()]
            continue
        words = terms.to_pylist()
        before = len(tail) if len(row) and row[0] == tail_row else 0
        words, row = (tail[-before:] if before else []) + words, np.concatenate([np.full(before, tail_row), row])
        rows, out = [], []
        for size in range(1, gram + 1):
            for i in range(max(0, before - size + 1), len(words) - size + 1):
                if row[i] == row[i + size - 1] and i + size > before:
                    rows.append(row[i])
                    out.append(zlib.crc32(" ".join(words[i : i + size]).encode()) % buckets)
        tail_row = int(row[-1])
        tail = [w for w, r in zip(words[-gram + 1 :], row[-gram + 1 :], strict=True) if r == tail_row]
        yield np.array(rows, np.int64), np.array(out, np.int64)


def feature_counts(texts: DataFrame, gram: int = GRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket in all texts; tasks send one row per bucket, and sums of those reach the driver."""

    def count(batches):
        table = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket in _buckets(batch.column(0), gram, buckets):
                table += np.bincount(bucket, minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(table)), pa.array(table[table > 0])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    size, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [((t + 1) * (all_s + size)) / ((s + 1) * (all_t + size)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    buckets = len(gain)

    def score(batches):
        for batch in batches:
            rows = batch.num_rows
            n, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for row, bucket in _buckets(batch.column(1), gram, buckets):
                n += np.bincount(row, minlength=rows)
                np.add.at(total, row, gain[bucket])
            # n words make n + (n - 1) + ... features, as far as there are words.
            words = n if gram == 1 else np.array([_words(x, gram) for x in n.tolist()], np.int64)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            arrays = [batch.column(0), pa.array(words), pa.array(n), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def _words(features: int, gram: int) -> int:
    words = 0
    while sum(max(0, words + 1 - k) for k in range(gram)) <= features and features:
        words += 1
        if sum(max(0, words - k) for k in range(gram)) == features:
            break
    return words


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel noise of an id, a whole number."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


# ---------------------------------------------------------------- the cutoff

Key = tuple[int, int]  # (-score, id): smaller is better


def _medians(batches: Iterator[pa.RecordBatch], pivot: Key | None) -> Iterator[pa.RecordBatch]:
    """Per side of the pivot (-1 before, 0 equal, 1 after; without one all are after): medians and sizes of chunks."""
    held: dict[int, list[np.ndarray]] = {-1: [], 1: []}
    equal = 0

    def flush(side: int, least: int):
        keys = np.concatenate(held[side]) if held[side] else np.zeros((0, 2), np.int64)
        while len(keys) >= least:
            part, keys = keys[:CHUNK], keys[CHUNK:]
            part = part[np.lexsort((part[:, 1], part[:, 0]))]
            a, b = part[(len(part) - 1) // 2]
            yield side, int(a), int(b), len(part)
            if not len(keys):
                break
        held[side] = [keys] if len(keys) else []

    def rows(found):
        columns = list(zip(*found, strict=True)) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["side", "a", "b", "n"])

    for batch in batches:
        keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
        side = np.ones(len(keys), np.int64)
        if pivot is not None:
            before = (keys[:, 0] < pivot[0]) | ((keys[:, 0] == pivot[0]) & (keys[:, 1] < pivot[1]))
            same = (keys[:, 0] == pivot[0]) & (keys[:, 1] == pivot[1])
            side = np.where(before, -1, np.where(same, 0, 1))
            equal += int(same.sum())
        out = []
        for s in (-1, 1):
            held[s].append(keys[side == s])
            if sum(map(len, held[s])) >= CHUNK:
                out += flush(s, CHUNK)
        if out:
            yield rows(out)
    rest = [*flush(-1, 1), *flush(1, 1)]
    yield rows(rest + ([(0, pivot[0], pivot[1], equal)] if equal else []))


def weighted_median(keys: list[Key], sizes: list[int]) -> Key:
    """The smallest key with at least half of the weight at or before it."""
    half, seen = sum(sizes), 0
    for key, n in sorted(zip(keys, sizes, strict=True)):
        seen += n
        if 2 * seen >= half:
            return key
    raise ValueError("no keys")


def _middle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One weighted median per side and task, with the weight of all it stands for."""
    keys: dict[int, list] = {}
    for batch in batches:
        for side, a, b, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            keys.setdefault(side, []).append(((a, b), n))
    rows = [(side, *weighted_median([k for k, _ in found], [n for _, n in found]), sum(n for _, n in found)) for side, found in sorted(keys.items())]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["side", "a", "b", "n"])


MEDIANS = "side long, a long, b long, n long"


def _sides(keys: DataFrame, pivot: Key | None, total: int, chunk_group: int = 4096) -> dict[int, list]:
    """Weighted medians of every side; with very many chunks, medians of groups of them, so that few reach the driver."""
    found = keys.mapInArrow(lambda b: _medians(b, pivot), MEDIANS)
    while total > CHUNK * chunk_group:
        total //= chunk_group
        found = found.repartition(max(1, total // CHUNK)).mapInArrow(_middle, MEDIANS)
    sides: dict[int, list] = {-1: [], 0: [], 1: []}
    for side, a, b, n in found.collect():
        sides[side].append(((a, b), n))
    return sides


def cutoff(keys: DataFrame, k: int, total: int, few: int = FEW) -> Key | None:
    """The k-th smallest of the keys (a, b), counting repeats; None for k = 0."""
    if k <= 0:
        return None
    low = high = None  # the cutoff lies strictly between
    written, sides, side = None, _sides(keys, None, total), 1
    rest = keys
    while True:
        here = sides[side]
        left = sum(n for _, n in here)
        if left <= few:
            few_keys = sorted(tuple(r) for r in rest.collect())
            return few_keys[k - 1]
        pivot = weighted_median([key for key, _ in here], [n for _, n in here])
        sides = _sides(rest, pivot, left)
        before, same = (sum(n for _, n in sides[s]) for s in (-1, 0))
        if k <= before:
            side, high = -1, pivot
        elif k <= before + same:
            return pivot
        else:
            side, low, k = 1, pivot, k - before - same
        after = sum(n for _, n in sides[side])
        rest = _between(keys if written is None else written[0], low, high)
        if written is None or 4 * after <= written[1]:
            rest = materialize(rest, "resample-keys")
            written = (rest, after)


def _between(keys: DataFrame, low: Key | None, high: Key | None) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    if low is not None:
        keys = keys.where((a >= low[0]) & ((a > low[0]) | (b > low[1])))
    if high is not None:
        keys = keys.where((a <= high[0]) & ((a < high[0]) | (b < high[1])))
    return keys


# ---------------------------------------------------------------- the draw


def draw(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, gram: int = GRAM, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; the rank is null where it is not drawn."""
    gain = gains(feature_counts(docs, gram, buckets), feature_counts(target, gram, buckets))
    scored = weights(docs, gain, gram).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialize(scored, "resample-scores")
    able = F.col("n_words") >= min_words
    n = scored.where(able).count()
    k = percent * n // 100
    a, b = -F.col("score"), F.coalesce("doc_id", F.lit(LAST_ID))
    last = cutoff(scored.where(able).select(a.alias("a"), b.alias("b")), k, n)
    drawn = F.lit(False) if last is None else able & ((a < last[0]) | ((a == last[0]) & (b <= last[1])))
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), "n_features", "weight"]
    winners = ranked(scored.where(drawn).select(*columns), [c if not isinstance(c, str) else F.col(c) for c in order], "rank", "resample-winners")
    # Rows with the very key of the cutoff may be more than are left to draw.
    winners = winners.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")).unionByName(winners.select(*columns, "rank"))


def keep_drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, columns as they are. Rows that share a doc_id are kept together if one is drawn."""
    ids = draw(docs, target, **options).where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")), "left_semi")

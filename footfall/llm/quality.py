"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text's features are hashed counts of word shapes (letter case, digits and punctuation with runs
collapsed), pairs of neighbouring shapes, words repeated after one another and line lengths, and beside them hashed
words and runs of three bytes, which tell texts of one shape apart in any script. A bounded
sample of labelled rows (``SAMPLE`` per label) gives the term weights, the latent space (truncated SVD) and the labelled
vectors. Those are broadcast, and every document is scored by exact cosine products with all of them, in blocks; its ``NEIGHBOURS``
nearest vote with weights that fall off with the distance.

Only the text is an input of the score. Labels of rows whose crc32(doc_id as text) mod 4 is 2 are held out.

Defined results: a null text is empty; a text without words scores 0; rows that share a doc_id are scored each;
labels other than 0 and 1 are ignored, and of several labels of a doc_id the smallest counts; without any
labelled document every score is 0. Other columns are passed over, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from footfall.llm.words import P, SMALL_SLICE, mix, running, slices, word_bounds, word_hashes
from footfall.session import bounded_batches, given_back, lean

SAMPLE = 1500
SHAPES, CONTENT = 2048, 1024
FEATURES = SHAPES + CONTENT
CONTENT_WEIGHT = 0.3
DIMENSIONS = 48
NEIGHBOURS = 15
WARMTH = 0.05
THRESHOLD = 0.7
BLOCK = 512
HELD_OUT = 2

# Shape code of a byte: letters by case (bytes of multi-byte characters count as small letters), digits, or the byte itself.
_CODE = np.arange(256, dtype=np.uint8)
_CODE[ord("a") : ord("z") + 1] = 1
_CODE[128:] = 1
_CODE[ord("A") : ord("Z") + 1] = 2
_CODE[ord("0") : ord("9") + 1] = 3
_SHAPE = mix(_CODE.astype(np.uint64) + np.uint64(1))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed features: one row per text of a slice."""
    n = len(offsets) - 1
    starts, ends = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros((n, FEATURES), np.float32)
    words, first = word_hashes(data, offsets)
    row = np.repeat(np.arange(n), np.diff(first))
    # Shapes: within a word only the bytes whose code differs from the one before count.
    depth = np.zeros(len(data) + 1, np.int8)
    depth[starts] += 1
    depth[ends] -= 1
    inside = np.cumsum(depth[:-1]) > 0
    code = _CODE[data]
    kept = inside.copy()
    kept[1:] &= code[1:] != code[:-1]
    kept[starts] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    sums, down = running(_SHAPE[data[kept]])
    a, b = place[starts], place[ends]
    shape = mix((sums[b] - sums[a]) * down[a])
    follows = np.zeros(len(words), bool)
    follows[1:] = row[1:] == row[:-1]
    pair = shape.copy()
    pair[1:] = mix(shape[:-1] * np.uint64(P) + shape[1:])
    again = np.zeros(len(words), bool)
    again[1:] = follows[1:] & (words[1:] == words[:-1])
    # Lines: how many words they have, in powers of two.
    breaks = np.concatenate([[0], np.cumsum(data == 10)])[starts]
    line = row.astype(np.int64) << 32 | breaks
    cut = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    length = np.diff(np.append(cut, len(line)))
    parts = [
        (row, mix(shape)), (row[follows], pair[follows]), (row[again], np.full(int(again.sum()), mix(np.array([7], np.uint64))[0])),
        (row[cut], mix(np.log2(length).astype(np.uint64) + np.uint64(1 << 40))),
    ]
    at = [r * FEATURES + (f % np.uint64(SHAPES)).astype(np.int64) for r, f in parts]
    # Words, and runs of three bytes inside words.
    triple = np.flatnonzero(inside[:-2] & inside[1:-1] & inside[2:]) if len(data) > 2 else np.zeros(0, np.int64)
    b = data.astype(np.uint64)
    code = mix(b[triple] << np.uint64(16) | b[triple + 1] << np.uint64(8) | b[triple + 2] | np.uint64(1 << 32))
    of_row = np.searchsorted(offsets, triple, "right") - 1
    one = triple + 2 < offsets[of_row + 1]  # not across the end of a text
    code, of_row = code[one], of_row[one]
    at += [r * FEATURES + SHAPES + (f % np.uint64(CONTENT)).astype(np.int64) for r, f in ((row, mix(words)), (of_row, code))]
    at = np.concatenate(at)
    return np.bincount(at, minlength=n * FEATURES).reshape(n, FEATURES).astype(np.float32)


def feature_blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Features of at most ``BLOCK`` texts at a time: many short ones take no more memory than few."""
    for a in range(0, len(offsets) - 1, BLOCK):
        part = offsets[a : a + BLOCK + 1]
        yield features(data[part[0] : part[-1]], part - part[0])


@dataclass
class Model:
    weight: np.ndarray  # per feature
    space: np.ndarray  # features x dimensions
    vectors: np.ndarray  # labelled rows x dimensions, unit length
    labels: np.ndarray

    def embed(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.weight) @ self.space)

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(counts))
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(counts), BLOCK):
            near = self.embed(counts[i : i + BLOCK]) @ self.vectors.T
            top = np.argpartition(near, -k, axis=1)[:, -k:]
            cosine = np.take_along_axis(near, top, 1)
            w = np.exp((cosine - cosine.max(1, keepdims=True)) / WARMTH)
            out[i : i + BLOCK] = (w * self.labels[top]).sum(1) / w.sum(1)
        out[counts.sum(1) == 0] = 0.0
        return np.clip(out, 0.0, 1.0)


def _weighted(counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Shapes and content each as a unit vector, content with less weight."""
    x = np.log1p(counts)
    x *= weight
    for part, share in ((x[:, :SHAPES], 1), (x[:, SHAPES:], CONTENT_WEIGHT)):
        size = np.linalg.norm(part, axis=1, keepdims=True)
        part /= np.where(size > 0, size, 1)
        part *= share
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def fit(counts: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Term weights and truncated SVD (randomized, with power steps) of the sample."""
    if not len(labels):
        return Model(np.ones(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    weight = (1 + np.log((1 + len(counts)) / (1 + (counts > 0).sum(0)))).astype(np.float32)
    x = _weighted(counts, weight)
    d = min(DIMENSIONS, *x.shape)
    base = np.linalg.qr(x.T @ (x @ np.random.default_rng(seed).standard_normal((x.shape[1], d + 8)).astype(np.float32)))[0]
    for _ in range(4):
        base = np.linalg.qr(x.T @ (x @ base))[0]
    _, values, right = np.linalg.svd(x @ base, full_matrices=False)
    space = (base @ right.T)[:, :d].astype(np.float32)
    # Directions are evened out part of the way: rare kinds of text have small singular values.
    space /= np.sqrt(np.maximum(values[:d], 1e-6)).astype(np.float32)
    model = Model(weight, space, np.zeros((0, d), np.float32), labels.astype(np.float64))
    model.vectors = _unit(x @ space).astype(np.float32)
    return model


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in slices(batch.column(1), SMALL_SLICE):
            rows = [_sparse(x) for counts in feature_blocks(data, offsets) for x in counts]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, pa.binary())], names=["label", "counts"])


def _sparse(counts: np.ndarray) -> bytes:
    """The counts of a row above 0: their places, then the counts."""
    at = np.flatnonzero(counts)
    return at.astype("<u2").tobytes() + counts[at].astype("<f4").tobytes()


def _fill(counts: np.ndarray, sparse: bytes) -> None:
    n = len(sparse) // 6
    counts[np.frombuffer(sparse, "<u2", n)] = np.frombuffer(sparse, "<f4", n, 2 * n)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most ``SAMPLE`` documents of each label, chosen by a hash of their id."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_q"))
    known = known.where(~held_out(F.col("_id")))
    parts = [known.where(F.col("_q") == label).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE) for label in (0, 1)]
    # At most twice SAMPLE rows, so the list may be broadcast; the documents are read once for both labels.
    some = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select("doc_id", "text").join(some, F.col("doc_id") == F.col("_id")).select("_q", F.coalesce("text", F.lit("")).alias("text"), "_id")
    texts = texts.groupBy("_id").agg(F.min("_q").alias("_q"), F.min("text").alias("text"))
    rows = texts.select(F.col("_q").cast("int").alias("label"), "text").mapInArrow(lean(_count_rows), "label int, counts binary").collect()
    counts = np.zeros((len(rows), FEATURES), np.float32)
    for at, r in zip(counts, rows, strict=True):
        _fill(at, r["counts"])
    order = np.lexsort(counts.T[::-1]) if len(rows) else np.zeros(0, int)  # the order of collected rows does not matter
    counts, known = counts[order], np.array([r["label"] for r in rows], np.float64)[order]
    return fit(counts, known)


def scorer(docs: DataFrame, labels: DataFrame):
    """A column function from a text to its score. Only texts go to Python, and a number comes back."""
    bounded_batches(docs.sparkSession)
    model = train(docs, labels)

    def scored(text: pa.Array) -> pa.Array:
        parts = [model.score(counts) for _, _, data, offsets in slices(text, SMALL_SLICE) for counts in feature_blocks(data, offsets)]
        return given_back(pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64()))

    return F.arrow_udf(scored, T.DoubleType())


def score(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with their score in a column that no other has: (docs, name of it)."""
    name = "score"
    while name in docs.columns:
        name = f"_{name}"
    return docs.withColumn(name, scorer(docs, labels)(F.col("text"))), name


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns."""
    out, _ = score(docs.select("doc_id", "text"), labels)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, columns as they are."""
    scored, name = score(docs, labels)
    return scored.where(F.col(name) >= THRESHOLD).select(*docs.columns)

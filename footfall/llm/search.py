"""Ranked lexical search by bag deduplication.

1. Every document is cut down to the terms of the items: n (all its terms) and a vector of (term number, tf), written once.
   Terms are looked up by their bytes.
2. Documents with the same vector and the same m are one class: rows are grouped by a hash, m and the vector itself, so a hash that
   meets another vector's makes no class. Copies collapse on the map side.
3. Document frequencies and scores are computed once per class. A task keeps the best ``TOP`` classes of each item, by score
   and smallest doc_id: a document that is behind the first document of ``TOP`` other classes cannot be on the list.
4. The classes on the lists expand to their members by ascending doc_id.

Items are a stated query set. Their terms go to every task, in blocks of at most ``BLOCK_ITEMS`` items and about
``BLOCK_BYTES`` bytes of text; more items make more passes over the documents. N and L are counts over all documents.

Score of a document for an item: the sum over the item's terms, repeats included, of
``w * ((1000000000 * tf) div (1000 * tf + 12 * m))``, with w and m as in ``term_weights`` and ``length_factor``.

Defined results: null and empty texts have no terms, so such items have no list; a long text is read whole, in pieces; rows that share a doc_id are
documents each and follow one another, null doc_ids come last among equal scores; rows that share an item_id are lists of one id, and repeated
rows give repeated lists; empty tables give no rows. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.terms import term_pieces
from footfall.session import materialize

TOP = 20
BLOCK_ITEMS = 5_000
BLOCK_BYTES = 4 << 20
CELLS = 1 << 20  # scores held at once: classes x items
POSTINGS = 1 << 20  # term weights expanded at once
LAST_ID = (1 << 63) - 1

BAG = np.dtype([("term", "<i4"), ("tf", "<i4")])


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """w per term: floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def length_factor(n_docs: int, all_terms: int) -> Column:
    """m of a document with n terms: 75 + 25 n N div L. The product may leave 64 bits on very large corpora, decimals hold it."""
    return F.expr(f"75L + (cast(n AS decimal(20, 0)) * 25BD * {n_docs}BD) div {max(all_terms, 1)}BD")


@dataclass
class Items:
    """A block of items: their terms, and per term the items that have it with its repeats."""

    ids: list
    terms: pa.Array
    first: np.ndarray  # of each term's postings; one more entry than terms
    item: np.ndarray
    repeats: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        """Items in the given order; rows are (item_id, text)."""
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1] or ""))
        counts = [Counter() for _ in rows]
        for row, terms in term_pieces(pa.array([t for _, t in rows], pa.string())):
            for i, term in zip(row.tolist(), terms.to_pylist(), strict=True):
                counts[i][term] += 1
        names = sorted(set().union(*counts)) if counts else []
        number = {t: k for k, t in enumerate(names)}
        cells = sorted((number[t], i, c) for i, found in enumerate(counts) for t, c in found.items())
        term, item, repeats = (np.array(c, np.int64) for c in zip(*cells, strict=True)) if cells else (np.zeros(0, np.int64),) * 3
        return cls([i for i, _ in rows], pa.array(names, pa.string()), np.searchsorted(term, np.arange(len(names) + 1)), item, repeats)


def _bag_rows(batches: Iterator[pa.RecordBatch], terms: pa.Array) -> Iterator[pa.RecordBatch]:
    """doc_id, n, bag of every row; the bag is sorted by term."""
    size = max(len(terms), 1)
    for batch in batches:
        rows = batch.num_rows
        n, cells, tf = np.zeros(rows, np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row, found in term_pieces(batch.column(1)):
            n += np.bincount(row, minlength=rows)
            at = pc.index_in(found, value_set=terms)
            hit = at.is_valid().to_numpy(zero_copy_only=False)
            cell, count = np.unique(row[hit] * size + at.drop_null().to_numpy().astype(np.int64), return_counts=True)
            cells.append(cell)
            tf.append(count)
        # Pieces of one long text may hold the same term.
        cell, back = np.unique(np.concatenate(cells), return_inverse=True)
        count = np.zeros(len(cell), np.int64)
        np.add.at(count, back, np.concatenate(tf))
        bag = np.zeros(len(cell), BAG)
        bag["term"], bag["tf"] = cell % size, count
        ends = np.searchsorted(cell, np.arange(rows + 1) * size) * BAG.itemsize
        bags = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(bag.tobytes())])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), bags], names=["doc_id", "n", "bag"])


def _bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of bags, and the row of each."""
    rows = [np.frombuffer(x, BAG) for x in column.to_pylist()]
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    return (np.concatenate(rows) if rows else np.zeros(0, BAG)), row


def _frequencies(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    df = np.zeros(n_terms, np.int64)
    for batch in batches:
        entries, row = _bags(batch.column(1))
        np.add.at(df, entries["term"], batch.column(0).to_numpy()[row])
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(df)), pa.array(df[df > 0])], names=["term", "df"])


def _best(score: np.ndarray, order: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best positive scores, best first; equal scores by ``order``."""
    some = np.flatnonzero(score > 0)
    if len(some) > top:
        least = np.partition(score[some], len(some) - top)[len(some) - top]
        some = some[score[some] >= least]
    return some[np.lexsort((order[some], -score[some]))][:top]


def _score_rows(batches: Iterator[pa.RecordBatch], items: Items, weight: np.ndarray, top: int) -> Iterator[pa.RecordBatch]:
    """Best classes of each item in this task: item, score, lead, h, m, bag."""
    lists: list[list] = [[] for _ in items.ids]  # (-score, lead, h, m, bag) in order
    least = np.ones(len(items.ids), np.int64)  # a lower score cannot be on the item's list
    per_term = np.diff(items.first)
    step = max(1, CELLS // max(1, len(items.ids)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            h, m, bags, lead = (part.column(i) for i in range(4))
            m, lead = m.to_numpy(), lead.to_numpy()
            entries, row = _bags(bags)
            tf = entries["tf"].astype(np.int64)
            value = weight[entries["term"]] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
            score = np.zeros(part.num_rows * len(items.ids), np.int64)
            size = per_term[entries["term"]]
            cuts = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + POSTINGS, POSTINGS), "left")
            for a, b in zip(cuts[:-1], [*cuts[1:-1], len(size)], strict=True):
                n = size[a:b]
                at = np.arange(n.sum()) + np.repeat(items.first[entries["term"][a:b]] - (np.cumsum(n) - n), n)
                np.add.at(score, np.repeat(row[a:b], n) * len(items.ids) + items.item[at], np.repeat(value[a:b], n) * items.repeats[at])
            score = score.reshape(part.num_rows, len(items.ids))
            for i in np.flatnonzero(score.max(axis=0) >= least).tolist():
                column, held = score[:, i], lists[i]
                found = [(-int(column[k]), int(lead[k]), h[int(k)].as_py(), int(m[k]), bags[int(k)].as_py()) for k in _best(column, lead, top)]
                lists[i] = sorted(held + found)[:top]
                if len(lists[i]) == top:
                    least[i] = -lists[i][-1][0]
    rows = [(i, -s, *rest) for i, held in enumerate(lists) for s, *rest in held]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["item", "score", "lead", "h", "m", "bag"]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def bags(docs: DataFrame, terms: pa.Array) -> DataFrame:
    """doc_id, n, bag of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda b: _bag_rows(b, terms), "doc_id long, n long, bag binary")


def _search_block(docs: DataFrame, items: Items, top: int) -> DataFrame:
    spark = docs.sparkSession
    found = materialize(bags(docs, items.terms), "search-bags")
    n_docs, all_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    member = found.where(F.length("bag") > 0).select(
        F.coalesce("doc_id", F.lit(LAST_ID)).alias("_id"), "doc_id", F.xxhash64("bag").alias("h"), length_factor(n_docs, all_terms).alias("m"), "bag"
    )
    classes = member.groupBy("h", "m", "bag").agg(F.min("_id").alias("lead"), F.count("*").alias("n_docs"))
    classes = materialize(classes, "search-classes")
    n_terms = len(items.terms)
    seen = classes.select("n_docs", "bag").mapInArrow(lambda b: _frequencies(b, n_terms), "term long, df long")
    df = np.zeros(n_terms, np.int64)
    for term, total in seen.groupBy("term").agg(F.sum("df")).collect():  # at most one row per term of the items
        df[term] = total
    weight = term_weights(df, n_docs)
    scored = classes.select("h", "m", "bag", "lead").mapInArrow(
        lambda b: _score_rows(b, items, weight, top), "item int, score long, lead long, h long, m long, bag binary"
    )
    first = Window.partitionBy("item").orderBy(F.desc("score"), "lead", "h", "m", "bag")
    lists = scored.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= top).drop("_r", "lead")
    lists = materialize(lists, "search-lists")  # at most top rows per item
    key = ["h", "m", "bag"]
    # At most top * block_items pairs of numbers. The bag itself decides below; before that a task keeps top rows of a class.
    wanted = member.join(F.broadcast(lists.select("h", "m").distinct()), ["h", "m"])
    nearest = Window.partitionBy(*key).orderBy("_id")
    wanted = wanted.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= top).drop("_r")
    place = Window.partitionBy("item").orderBy(F.desc("score"), "_id", F.col("doc_id").isNull())
    out = lists.join(wanted, key).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, item) for i, item in enumerate(items.ids)], "item int, item_id long")
    return out.join(names, "item").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item (item_id, text)."""
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    n, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-n // block_items), -(-size // block_bytes), 1)
    asked = asked.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    parts = [
        _search_block(docs, Items.of([tuple(r) for r in asked.where(F.col("_block") == b).select("item_id", "text").collect()]), top)
        for b in range(blocks)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

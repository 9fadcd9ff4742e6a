"""Removal of repeated passages by minimum-hash anchors and full-length hashes, in place of prefix doubling.

Positions whose 50-byte strings are equal get equal ranks. Ranks of 20, 35 and 50 bytes are hashes of the text, none is
made from a pair of earlier ranks, and a position leaves as soon as its rank is unique:

1. Rank of ``STEP`` (20) bytes. Each 50-byte string is represented by the smallest-hashed 20-byte string in
   it (its anchor), so neighbouring positions share one row (a run), and equal 50-byte strings share an anchor. Runs are
   sorted by (rank of the anchor, rank of all bytes that the run's strings cover). A run whose anchor
   occurs in one document leaves; one whose whole cover occurs in a smaller document is decided.
2. The offset grows to the sides of the anchor: a 50-byte string has 15 more bytes on the left or on the right
   of it. Runs whose ranks of neither pair (anchor, side) occur in another document leave.
3. What is left, edges of passages, is ranked string by string at the full 50 bytes.

An anchor with more than ``HOT_RUNS`` runs skips 1 and 2: its strings are ranked at the full length at once, each batch
decides what it can and sends only its smallest document of every string, and the strings are dealt by their own rank. So
no group holds every document of a frequent line. A batch counts anchors that it has ``OFTEN`` times or more, hence a group
has at most HOT_RUNS + (OFTEN - 1) * batches runs of one anchor.

Ranks are hashes; sorting is done in Spark tasks, each holding the rows of one bucket of the rank, whose
number grows with the bytes. Texts are shuffled once by document, everything else moves as
arrays. Equal (rank, document) rows of a task go out once per position only as bytes of an array.

Defined results: nulls are empty texts; a document shorter than 50 bytes keeps all; only a strictly smaller doc_id
counts, so rows that share a doc_id do not remove each other; a null doc_id is larger than all others and equal to other nulls.
An empty table gives no rows. All other columns are passed through, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from footfall.llm.words import BYTE_CODE, mix, running, slices
from footfall.session import bounded_batches, given_back, lean, materialize

LENGTH = 50
STEP = 20
WINDOW = LENGTH - STEP + 1
SIDE = (LENGTH - STEP) // 2
SLICE = 512 << 10
BATCH_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20  # a task holds about 20 times that in Python while it ranks a bucket
HOT_RUNS, OFTEN = 5_000, 4
HOT_STRINGS = 4 << 20  # strings of hot anchors that a batch holds before it goes out
RUN, STRING, DECIDED = range(3)
MOST_ID = np.iinfo(np.int64).max
POSITION_BITS = np.uint64(28)
MASK = np.uint64((1 << 28) - 1)
SALT = np.uint64(0xA5A5A5A55A5A5A5A)


def buckets_for(n_bytes: int) -> int:
    """Buckets of about BUCKET_BYTES of text; beyond 4096 of them they grow to 16 times that first."""
    small = -(-n_bytes // BUCKET_BYTES)
    return max(1, small if small <= 4096 else max(4096, small // 16))


def _bucket(rank: np.ndarray, n: int) -> np.ndarray:
    # Anchors are minima of hashes, so their bits are spread once more.
    return ((mix(rank ^ SALT) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def _anchored(sums: np.ndarray, down: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last string of every run of a slice, where its anchor starts, the anchor's rank."""
    size = len(sums) - 1
    grams = mix((sums[STEP:] - sums[:-STEP]) * down[: size - STEP + 1])
    if len(grams) > int(MASK):
        raise ValueError("a text of 2**28 bytes or more has places that positions cannot hold")
    marked = (grams & ~MASK) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_min(marked, WINDOW) & MASK).astype(np.int64)  # leftmost smallest of every string
    # Strings that would cross into the next row start in the last 49 bytes of a row.
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, np.maximum(offsets[:-1], offsets[1:] - LENGTH + 1), 1)
    np.add.at(edge, offsets[1:], -1)
    inside = np.cumsum(edge)[: len(at)] == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (at[1:] != at[:-1])
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    return lo, hi, at[lo], grams[at[lo]]


def runs(data: np.ndarray, offsets: np.ndarray):
    """Runs of a slice: row, first position (in the row), how many positions, anchor rank, cover rank, left and right rank.

    A side rank is 0 where the row has no ``SIDE`` bytes there.
    """
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint8, np.uint8))
    if len(data) < LENGTH:
        return empty
    sums, down = running(BYTE_CODE[data])

    def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((sums[b] - sums[a]) * down[a])

    lo, hi, p, anchor = _anchored(sums, down, offsets)
    row = np.searchsorted(offsets, lo, "right") - 1
    start, end = offsets[row], offsets[row + 1]
    has_left, has_right = p - SIDE >= start, p + STEP + SIDE <= end
    left = np.where(has_left, np.maximum(1, rank(np.where(has_left, p - SIDE, 0), np.where(has_left, p, 0)) >> np.uint64(56)), 0)
    right = np.where(has_right, np.maximum(1, rank(np.where(has_right, p + STEP, 0), np.where(has_right, p + STEP + SIDE, 0)) >> np.uint64(56)), 0)
    return row, lo - start, hi - lo + 1, anchor, rank(lo, hi + LENGTH), left.astype(np.uint8), right.astype(np.uint8)


def _strings(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of some runs: row, position (in the row), rank of the full length."""
    sums, down = running(BYTE_CODE[data])
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    row = np.repeat(row, n)
    p = offsets[row] + at
    return row, at, mix((sums[p + LENGTH] - sums[p]) * down[p])


def _anchor_counts(batches, often: int):
    found, size = [], 0

    def flush():
        anchor, times = np.unique(np.concatenate(found), return_counts=True)
        some = times >= often
        return pa.RecordBatch.from_arrays([pa.array(anchor[some].view(np.int64)), pa.array(times[some].astype(np.int64))], names=["anchor", "n"])

    for batch in batches:
        for _, _, data, offsets in slices(pc.fill_null(batch.column(0), ""), SLICE):
            if len(data) >= LENGTH:
                found.append(_anchored(*running(BYTE_CODE[data]), offsets)[3])
                size += len(data)
            if size >= BATCH_BYTES:
                yield flush()
                found, size = [], 0
    if found:
        yield flush()


def hot_anchors(rows: DataFrame) -> np.ndarray:
    """Sorted ranks of the anchors with more than ``HOT_RUNS`` runs. They only say how runs are dealt, not what is removed."""
    often = OFTEN
    counts = rows.select("text").mapInArrow(lean(lambda b: _anchor_counts(b, often)), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return np.sort(np.array([r[0] for r in counts.where(F.col("n") > HOT_RUNS).select("anchor").collect()], np.int64).view(np.uint64))


# ------------------------------------------------------------------ arrays in binary columns


def _cut(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit numbers."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _join(parts: list[bytes], width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, :width] = raw
    return full.view("<u8").ravel()


class _Documents:
    """Row identities of a batch: doc_id (a text hash for null ids), whether null, CRC of the text."""

    def __init__(self):
        self.id, self.null, self.crc = [], [], []

    def add(self, ids: list, texts: list[bytes]) -> None:
        for i, t in zip(ids, texts, strict=True):
            self.crc.append(zlib.crc32(t))
            self.null.append(i is None)
            self.id.append(int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) if i is None else i)

    def arrays(self):
        return np.array(self.id, np.int64), np.array(self.null, np.uint8), np.array(self.crc, np.uint32)


RUNS = "bucket int, kind int, rank binary, anchor binary, cover binary, doc binary, lo binary, lo_high binary, n binary, side_left binary, side_right binary, ids binary, nulls binary, crcs binary"
MARKS = "part int, home int, doc binary, lo binary, n binary, decided binary, ids binary, nulls binary, crcs binary"
STRINGS = "bucket int, rank binary, doc binary, lo binary, n binary, ids binary, nulls binary, crcs binary"


def _split(bucket: np.ndarray, row: np.ndarray, ids, nulls, crcs, columns) -> Iterator[dict]:
    """Per bucket the columns' bytes, with the documents that occur in it numbered from 0."""
    order = np.lexsort((row, bucket))
    bucket, row = bucket[order], row[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
        if a == b:
            continue
        here, doc = np.unique(row[a:b], return_inverse=True)
        some = order[a:b]
        out = {"bucket": int(bucket[a]), "doc": doc.astype("<u4").tobytes()}
        out |= {name: f(values[some]) for name, (values, f) in columns.items()}
        out |= {"ids": ids[here].astype("<i8").tobytes(), "nulls": nulls[here].tobytes(), "crcs": crcs[here].astype("<u4").tobytes()}
        yield out


def _emit(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n, b"") for r in rows], pa.int32() if k == "int" else pa.binary()) for n, k in fields], names=[n for n, _ in fields])


def _spans(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring positions, in order, as pieces of at most 255: where each starts in the arrays, how many."""
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    k = np.arange(len(row))
    first |= (k - np.maximum.accumulate(np.where(first, k, 0))) % 255 == 0
    starts = np.flatnonzero(first)
    return starts, np.diff(np.append(starts, len(row)))


def _hot_rows(strings: list, docs: _Documents, n_buckets: int) -> Iterator[dict]:
    """Strings of hot anchors: those of the batch's smallest document by their rank, all others decided."""
    ids, nulls, crcs = docs.arrays()
    row, at, rank = (np.concatenate(x) for x in zip(*strings, strict=True))
    order = np.where(nulls > 0, MOST_ID, ids)[row]
    o, new = _classes(rank)
    _, least, _ = _extremes(new, order[o])
    gone = np.zeros(len(o), bool)
    gone[o] = order[o] > least
    position = lambda x: {"lo": (x, lambda x: _cut(x, 2)), "lo_high": (x >> 16, lambda x: _cut(x, 2))}
    columns = position(at[~gone]) | {"rank": (rank[~gone], lambda x: _cut(x, 8))}
    for r in _split(_bucket(rank[~gone], n_buckets), row[~gone], ids, nulls, crcs, columns):
        yield r | {"kind": STRING}
    row, at = row[gone], at[gone]
    starts, n = _spans(row, at)
    columns = position(at[starts]) | {"n": (n, lambda x: _cut(x, 1))}
    for r in _split(_part_of(ids, crcs, n_buckets)[row[starts]], row[starts], ids, nulls, crcs, columns):
        yield r | {"kind": DECIDED}


def _run_rows(batches, n_buckets: int, hot: np.ndarray = np.zeros(0, np.uint64)):
    docs, found, strings, size, n_strings, first = _Documents(), [], [], 0, 0, 0

    def flush():
        row, lo, n, anchor, cover, left, right = (np.concatenate(x) for x in zip(*found, strict=True))
        columns = {
            "anchor": (anchor, lambda x: _cut(x, 6)), "cover": (cover, lambda x: _cut(x, 8)),
            "lo": (lo, lambda x: _cut(x, 2)), "lo_high": (lo >> 16, lambda x: _cut(x, 2)), "n": (n, lambda x: _cut(x, 1)),
            "side_left": (left, lambda x: x.tobytes()), "side_right": (right, lambda x: x.tobytes()),
        }
        rows = [r | {"kind": RUN} for r in _split(_bucket(anchor, n_buckets), row, *docs.arrays(), columns)]
        if n_strings:
            rows += _hot_rows(strings, docs, n_buckets)
        return _emit(rows, RUNS)

    for batch in batches:
        ids, texts = batch.column(0), pc.fill_null(batch.column(1), "")
        for a, b, data, offsets in slices(texts, SLICE):
            docs.add(ids[a:b].to_pylist(), [data[x:y].tobytes() for x, y in zip(offsets[:-1], offsets[1:], strict=True)])
            row, *rest = runs(data, offsets)
            if len(hot):
                is_hot = np.isin(rest[2], hot)
                if is_hot.any():
                    of, at, rank = _strings(data, offsets, row[is_hot], rest[0][is_hot], rest[1][is_hot])
                    strings.append((of + first, at, rank))
                    n_strings += len(at)
                    row, *rest = (x[~is_hot] for x in (row, *rest))
            found.append((row + first, *rest))
            first += b - a
            size += len(data)
            if size >= BATCH_BYTES or n_strings >= HOT_STRINGS:
                yield flush()
                docs, found, strings, size, n_strings, first = _Documents(), [], [], 0, 0, 0
    if found:
        yield flush()


class _Gathered:
    """The rows of one bucket, as arrays: documents numbered over the bucket, and their order for comparison."""

    def __init__(self, table: pa.Table):
        take = lambda c: [x.as_py() for x in table.column(c)]
        sizes = [len(x) // 4 for x in take("crcs")]
        before = np.cumsum([0, *sizes[:-1]])
        self.id = np.frombuffer(b"".join(take("ids")), "<i8")
        self.null = np.frombuffer(b"".join(take("nulls")), np.uint8)
        self.crc = np.frombuffer(b"".join(take("crcs")), "<u4")
        self.doc = np.concatenate([np.frombuffer(d, "<u4").astype(np.int64) + s for d, s in zip(take("doc"), before, strict=True)])
        order = np.where(self.null > 0, MOST_ID, self.id)[self.doc]
        self.order = order
        self.take = take


def _classes(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order (first key first) and the start flags of equal keys in it."""
    o = np.lexsort(keys[::-1])
    new = np.zeros(len(o), bool)
    new[:1] = True
    for k in keys:
        s = k[o]
        new[1:] |= s[1:] != s[:-1]
    return o, new


def _extremes(new: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class number of every sorted row, and least and greatest value of its class."""
    starts = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    return number, np.minimum.reduceat(values, starts)[number], np.maximum.reduceat(values, starts)[number]


def _position(g: _Gathered) -> np.ndarray:
    return _join(g.take("lo"), 2) | _join(g.take("lo_high"), 2) << np.uint64(16)


def _rank_runs(table: pa.Table, parts: int) -> pa.Table:
    """Decide runs by their cover, and pass on those that a neighbour in rank may still match in part."""
    g = _Gathered(table)
    anchor, cover = _join(g.take("anchor"), 6), _join(g.take("cover"), 8)
    o, new = _classes(anchor, cover)
    _, least, _ = _extremes(new, g.order[o])
    decided = np.zeros(len(o), bool)
    decided[o] = g.order[o] > least
    open_ = np.zeros(len(o), bool)
    # Of runs with one cover only those of the smallest document are compared further.
    some = o[g.order[o] == least]
    for side in ("side_left", "side_right"):
        rank = np.frombuffer(b"".join(g.take(side)), np.uint8)
        own = some[rank[some] > 0]
        if len(own):
            s, start = _classes(anchor[own], rank[own])
            _, a, b = _extremes(start, g.order[own][s])
            covers = np.zeros(len(s), bool)
            c = cover[own][s]
            _, x, y = _extremes(start, c)
            covers = x != y
            open_[own[s[(a != b) & covers]]] = True
    keep = np.flatnonzero(decided | open_)
    lo = _position(g)[keep]
    n = np.frombuffer(b"".join(g.take("n")), np.uint8)[keep]
    return _marks(g, g.doc[keep], parts, lo, n, decided[keep], table.column("bucket")[0].as_py())


def _rank_hot(table: pa.Table, parts: int) -> pa.Table:
    """Strings of hot anchors that a smaller document of another batch has too."""
    g = _Gathered(table)
    o, new = _classes(_join(g.take("rank"), 8))
    _, least, _ = _extremes(new, g.order[o])
    keep = np.sort(o[g.order[o] > least])
    return _marks(g, g.doc[keep], parts, _position(g)[keep], np.ones(len(keep), np.uint8), np.ones(len(keep), bool), 0)


def _pass_on(table: pa.Table, parts: int) -> pa.Table:
    """Strings of hot anchors that their batch has decided."""
    g = _Gathered(table)
    return _marks(g, g.doc, parts, _position(g), np.frombuffer(b"".join(g.take("n")), np.uint8), np.ones(len(g.doc), bool), 0)


def _rank_bucket(table: pa.Table, parts: int) -> pa.Table:
    steps = {RUN: _rank_runs, STRING: _rank_hot, DECIDED: _pass_on}
    kinds = sorted(pc.unique(table.column("kind")).to_pylist())
    if len(kinds) == 1:  # as a rule: no copy of the bucket
        return steps[kinds[0]](table, parts)
    return pa.concat_tables([steps[k](table.filter(pc.equal(table.column("kind"), k)), parts) for k in kinds])


def _part_of(ids: np.ndarray, crcs: np.ndarray, parts: int) -> np.ndarray:
    return _bucket(ids.view(np.uint64) ^ mix(crcs.astype(np.uint64)), parts)


def _marks(g: _Gathered, doc, parts: int, lo, n, decided, home: int) -> pa.Table:
    """Marked runs by the part that holds their document; ``home`` is the bucket of their anchors."""
    columns = {
        "lo": (lo, lambda x: x.astype("<u4").tobytes()), "n": (n, lambda x: x.astype(np.uint8).tobytes()),
        "decided": (decided, lambda x: x.astype(np.uint8).tobytes()),
    }
    part = _part_of(g.id, g.crc, parts)[doc] if len(doc) else np.zeros(0, np.int32)
    rows = [{**r, "part": r["bucket"], "home": home} for r in _split(part, doc, g.id, g.null, g.crc, columns)]
    return pa.Table.from_batches([_emit(rows, MARKS)])


def _rank_strings(table: pa.Table, parts: int) -> pa.Table:
    """The last step: strings of the full length that a smaller document has too."""
    g = _Gathered(table)
    rank = np.frombuffer(b"".join(g.take("rank")), "<u8")
    n = np.frombuffer(b"".join(g.take("n")), np.uint8).astype(np.int64)
    run = np.repeat(np.arange(len(n)), n)
    lo = np.frombuffer(b"".join(g.take("lo")), "<u4").astype(np.int64)[run] + np.arange(len(run)) - (np.cumsum(n) - n)[run]
    order, doc = g.order[run], g.doc[run]
    o, new = _classes(rank)
    _, least, _ = _extremes(new, order[o])
    keep = np.sort(o[order[o] > least])
    return _marks(g, doc[keep], parts, lo[keep], np.ones(len(keep), np.uint8), np.ones(len(keep), bool), 0)


def _by_document(marks: pa.Table) -> dict[tuple, list[np.ndarray]]:
    """(id, null, crc) -> lo, n, decided, home of all its marks."""
    if not marks.num_rows:
        return {}
    g = _Gathered(marks)
    lo = np.frombuffer(b"".join(g.take("lo")), "<u4").astype(np.int64)
    n = np.frombuffer(b"".join(g.take("n")), np.uint8).astype(np.int64)
    decided = np.frombuffer(b"".join(g.take("decided")), np.uint8) > 0
    home = np.repeat(np.array(g.take("home")), [len(x) for x in g.take("decided")])
    keys = list(zip(g.id.tolist(), g.null.tolist(), g.crc.tolist(), strict=True))
    numbers: dict[tuple, int] = {}
    same = np.array([numbers.setdefault(k, len(numbers)) for k in keys], np.int64)[g.doc]
    o = np.argsort(same, kind="stable")
    cuts = np.searchsorted(same[o], np.arange(len(numbers) + 1))
    return {k: [x[o[cuts[i] : cuts[i + 1]]] for x in (lo, n, decided, home)] for k, i in numbers.items()}


def _texts(docs: pa.Table) -> tuple[_Documents, list[bytes]]:
    texts = [b"" if t is None else t for t in docs.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]
    known = _Documents()
    known.add(docs.column("doc_id").to_pylist(), texts)
    return known, texts


def _string_rows(docs: pa.Table, marks: pa.Table) -> pa.Table:
    """All strings of the runs that are still open, ranked at full length.

    Equal strings share an anchor, so a run goes to its anchor's bucket as one piece: (first position, ranks)."""
    by = _by_document(marks)
    known, texts = _texts(docs)
    found, ranks, done = [], [np.zeros(0, np.uint64)], set()
    for i, key in enumerate(zip(known.id, known.null, known.crc, strict=True)):
        key = (key[0], int(key[1]), key[2])
        if key not in by or key in done:
            continue
        done.add(key)
        lo, n, decided, home = by[key]
        lo, n, home = lo[~decided], n[~decided], home[~decided]
        sums, down = running(BYTE_CODE[np.frombuffer(texts[i], np.uint8)])
        p = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        ranks.append(mix((sums[p + LENGTH] - sums[p]) * down[p]))
        found.append((np.full(len(lo), i), lo, n, home))
    if not found:
        return pa.Table.from_batches([_emit([], STRINGS)])
    row, lo, n, home = (np.concatenate(x) for x in zip(*found, strict=True))
    rank, first = np.concatenate(ranks), np.cumsum(n) - n

    def of_runs(some: np.ndarray) -> bytes:
        m = n[some]
        return rank[np.repeat(first[some] - (np.cumsum(m) - m), m) + np.arange(m.sum())].astype("<u8").tobytes()

    columns = {
        "rank": (np.arange(len(n)), of_runs), "lo": (lo, lambda x: x.astype("<u4").tobytes()), "n": (n, lambda x: x.astype(np.uint8).tobytes()),
    }
    return pa.Table.from_batches([_emit(list(_split(home.astype(np.int32), row, *known.arrays(), columns)), STRINGS)])


def _remove(docs: pa.Table, marks: pa.Table, names: list[str], as_text: bool) -> pa.Table:
    by = _by_document(marks)
    known, texts = _texts(docs)
    sizes, removed, spans, kept = [], [], [], []
    for key, text in zip(zip(known.id, known.null, known.crc, strict=True), texts, strict=True):
        lo, n, decided, _ = by.get((key[0], int(key[1]), key[2]), (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),) * 2)
        cover = np.zeros(len(text) + 1, np.int32)
        np.add.at(cover, lo[decided], 1)
        np.add.at(cover, (lo + n + LENGTH - 1)[decided], -1)
        gone = np.cumsum(cover[:-1]) > 0
        turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        sizes.append(len(text))
        removed.append(int(gone.sum()))
        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turn[::2], turn[1::2], strict=True)])
        kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes() if len(turn) else text)
    columns = [docs.column(c) for c in names]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    last = pa.array([x.decode(errors="ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
    columns += [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), last]
    return pa.Table.from_arrays(columns, names=[*names, "n_bytes", "n_removed", "spans", "kept"])


def cut_repeats(docs: DataFrame, others: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """Per row doc_id, the ``others`` as c0, c1 …, and n_bytes, n_removed, spans (start, end in bytes), kept.

    ``kept`` has the remaining bytes, or ``as_text`` what of them is whole characters."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)]
    )
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = buckets_for(n_bytes)
    hot = hot_anchors(rows) if n_bytes > HOT_RUNS else np.zeros(0, np.uint64)
    names = ["doc_id", *(f"c{i}" for i in range(len(others)))]

    found = rows.select("doc_id", "text").mapInArrow(lean(lambda b: _run_rows(b, n, hot)), RUNS)
    marks = materialize(found.groupBy("bucket").applyInArrow(lambda t: given_back(_rank_bucket(t, n)), MARKS), "suffix-runs")

    def part_rows(batches):
        for batch in batches:
            known, _ = _texts(pa.Table.from_batches([batch]))
            ids, _, crcs = known.arrays()
            yield batch.append_column("part", pa.array(_part_of(ids, crcs, n), pa.int32()))

    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType())])
    placed = rows.mapInArrow(lean(part_rows), schema)
    # Both cogroups below deal the same rows by the same key: Spark shuffles the texts once for both.
    strings = placed.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(lambda d, m: given_back(_string_rows(d, m)), STRINGS)
    late = strings.groupBy("bucket").applyInArrow(lambda t: given_back(_rank_strings(t, n)), MARKS)
    out = T.StructType([f for f in rows.schema.fields if f.name in names])
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    out = out.add("n_bytes", "long").add("n_removed", "long").add("spans", span).add("kept", "string" if as_text else "binary")
    both = marks.unionByName(late)
    return placed.groupBy("part").cogroup(both.groupBy("part")).applyInArrow(lambda d, m: given_back(_remove(d, m, names, as_text)), out)


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns."""
    return cut_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents with their repeated passages cut out, n_chars counted anew, all other columns kept.

    A cut may go through a multi-byte character; what is left of such a character is dropped.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = cut_repeats(docs, others, as_text=True)
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    columns |= {c: F.col(f"c{i}") for i, c in enumerate(others)}
    return out.select(*[columns[c].alias(c) for c in docs.columns])

"""N-gram Jaccard join: a grouped prefix join over word shingles.

Two documents link when ``5 * |A & B| >= 4 * |A | B|`` for their sets of 5-word shingles.

1. Shingles get one global order, rare ones first: by the level of a fixed-size counting sketch over all documents,
   then by hash. Any fixed order is exact; the sketch only makes prefixes selective.
2. A document's prefix is its first ``n - ceil(0.8 n) + l(n)`` shingles, ``l(n) = 1 + n // 20``: documents that link
   share at least ``min(l)`` shingles of their prefixes. Documents with the same size and prefix are one group.
3. Groups are filtered, not documents: rows (shingle, group) are sorted by shingle in Spark and read as a stream. First every group
   is compared with the smallest group of its shingles (hub), which links copies of a text without pairing them all. In large families of
   looser copies, groups not connected yet are then compared with a few neighbours in ``ROUNDS`` random orders. Last,
   pairs of groups that share enough shingles and are still not connected are compared, all of them. Shingles whose groups are all
   connected leave after every step.
4. A pair leaves the last comparison only if its parity signatures allow a link: every bit that differs is a shingle in one
   set only, so ``9 * differing bits > |A| + |B|`` excludes it. A frequent shingle is dealt in cells of ``BLOCK`` by ``BLOCK`` groups.
5. Groups expand into their distinct sets; a pair of sets is verified on the complete sets.

The links found connect the same documents as all links do: a pair is only left out when its documents are already connected.
Components follow by contraction.

Defined results: a null text is an empty one; documents without words link with nothing, equal texts have equal sets and
are one member; rows that share a doc_id count as one document for links; rows with a null doc_id link with
nothing and have a null component. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.components import components
from footfall.llm.words import SMALL_SLICE, mix, shingle_sets, slices
from footfall.session import bounded_batches, discard, lean, materialize, scratch

SKETCH_BITS = 22
FILTER_BITS = 23
PARTS = 64
SEEN_GROUPS = 200_000
ROUNDS = 3  # of comparing rows with their neighbours, before what is left is compared in full
NEIGHBOURS = 6
BLOCK = 1024
SIGNATURE_BITS = 1024
HELD_PAIRS = 100_000  # of groups that a task holds before Spark sums them up
SIZE_STEPS = 64  # steps of a doubling in the size that a group id carries


def least_overlap(n):
    """ceil(0.8 n): what a set of n shingles shares with any set it links to, at least."""
    return (4 * n + 4) // 5


def shared_needed(n):
    """l(n): how many prefix shingles two linking sets share at least (the smaller l counts)."""
    return 1 + n // 20


def prefix_size(n):
    return n - least_overlap(n) + shared_needed(n)


# ---------------------------------------------------------------- fixed-size tables over all rows


def _gather(rows: DataFrame, fill, size: int, combine: str) -> np.ndarray:
    """A table of fixed ``size``, filled by ``fill(table, batch)`` per task and combined in Spark.

    Only the finished table, whose size does not depend on the data, comes to the driver.
    """
    part = size // PARTS

    def make(batches):
        table = np.zeros(size, np.uint32)
        for batch in batches:
            fill(table, batch)
        keep = [i for i in range(PARTS) if table[i * part : (i + 1) * part].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keep, pa.int32()), pa.array([_pack(table[i * part : (i + 1) * part], combine) for i in keep], pa.binary())], names=["part", "data"]
        )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                here = _unpack(data, combine)
                sums[i] = here.astype(np.uint64) if i not in sums else (sums[i] + here if combine == "sum" else sums[i] | here)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([_pack(np.minimum(x, 0xFFFFFFFF).astype(np.uint32), combine) for x in sums.values()], pa.binary()),
            ],
            names=["part", "data"],
        )

    made = rows.mapInArrow(lean(make), "part int, data binary").repartition(PARTS, "part").mapInArrow(lean(add), "part int, data binary")
    table = np.zeros(size, np.uint32)
    for r in made.collect():
        table[r["part"] * part : (r["part"] + 1) * part] = _unpack(bytes(r["data"]), combine)
    return table


def _pack(x: np.ndarray, combine: str) -> bytes:
    """Counts as their low and high bytes apart, which compresses well; a count that does not fit stays at the most that does."""
    if combine == "or":
        return np.packbits(x > 0).tobytes()
    low = np.minimum(x, 0xFFFF).astype(np.uint16)
    return (low & 0xFF).astype(np.uint8).tobytes() + (low >> 8).astype(np.uint8).tobytes()


def _unpack(data: bytes, combine: str) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if combine == "or":
        return np.unpackbits(raw).astype(np.uint32)
    half = len(raw) // 2
    return raw[:half].astype(np.uint32) | raw[half:].astype(np.uint32) << np.uint32(8)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for a, b, data, offsets in slices(batch.column(1), SMALL_SLICE):
        yield a, b, shingle_sets(data, offsets)


def _count(table: np.ndarray, batch: pa.RecordBatch) -> None:
    for _, _, sets in _sets(batch):
        # In place: counts of a slice of their own would be twice as large as the table, for every slice.
        np.add.at(table, (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))


def rarity(rows: DataFrame) -> np.ndarray:
    """Per slot of the sketch a level that grows with the number of documents that have its shingles."""
    counts = _gather(rows, _count, 1 << SKETCH_BITS, "sum")
    return np.floor(2 * np.log2(counts.astype(np.float64) + 1)).astype(np.uint8)


# ---------------------------------------------------------------- documents, postings, sets


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a slice's sets one after the other, and where each set starts (one more entry than sets)."""
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.cumsum([0, *(len(s) for s in sets)])


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of every set, modulo 2**64."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def _signed(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers less 2**63."""
    return (x ^ np.uint64(1 << 63)).view(np.int64)


def _first_ids(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return _signed(_sums(mix(flat ^ np.uint64(0x1234567)), starts))


def _second_ids(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return _signed(_sums(mix(flat ^ np.uint64(0x89ABCDEF)), starts))


def _prefixes(flat: np.ndarray, starts: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The prefixes of a slice's sets, in no order, and where each starts. Rare shingles are small, frequent ones large."""
    order = levels[(flat >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | (mix(flat) >> np.uint64(8))
    n = np.diff(starts)
    size = np.where(n > 0, prefix_size(n), 0)
    parts = [np.zeros(0, np.uint64)]
    for a, b, p in zip(starts[:-1].tolist(), starts[1:].tolist(), size.tolist(), strict=True):
        x = order[a:b]
        if p < b - a:
            x.partition(p - 1)
        parts.append(x[:p])
    return np.concatenate(parts), np.cumsum([0, *size.tolist()])


def _group_ids(n: np.ndarray, prefixes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of size and prefix; its low 12 bits carry the size in steps of 2 ** (1 / 64), rounded down. 0 for empty sets."""
    h = mix(_sums(mix(prefixes), starts) ^ (n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    step = np.minimum(4095, (SIZE_STEPS * np.log2(np.maximum(n, 1))).astype(np.int64)).astype(np.uint64)
    return np.where(n > 0, _signed(h & ~np.uint64(0xFFF) | step), 0)


# Sizes n <= m can only link when 5 n >= 4 m; in steps, with one for rounding:
MOST_STEPS = int(np.ceil(SIZE_STEPS * np.log2(1.25))) + 1


def _document_rows(batches, levels):
    for batch in batches:
        for a, b, sets in _sets(batch):
            flat, starts = _flat(sets)
            n = np.diff(starts)
            groups = _group_ids(n, *_prefixes(flat, starts, levels))
            columns = [n, _first_ids(flat, starts), _second_ids(flat, starts), groups]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n", "s1", "s2", "g"]
            )


def _posting_rows(batches, levels):
    seen: set[int] = set()
    for batch in batches:
        for _, _, sets in _sets(batch):
            flat, starts = _flat(sets)
            prefixes, ends = _prefixes(flat, starts, levels)
            groups = _group_ids(np.diff(starts), prefixes, ends)
            fresh = np.zeros(len(sets), bool)
            for i, g in enumerate(groups.tolist()):
                fresh[i] = g not in seen  # else a copy: the group's rows are out already
                if fresh[i] and len(seen) < SEEN_GROUPS:
                    seen.add(g)
            size = np.diff(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefixes[np.repeat(fresh, size)].view(np.int64)), pa.array(np.repeat(groups[fresh], size[fresh]))], names=["token", "g"]
            )


def _hub_rows(batches):
    """Shared rows only: every (token, g) of a token with several groups, and the group it is compared with.

    Batches come sorted by token, then size, then group. The first group of a token is the hub until sizes are too far
    apart to link with it. The stream keeps one hub, however many groups share a token.
    """
    token = hub = last = held = None  # held: a first row whose token is not known to be shared yet
    for batch in batches:
        ts, gs = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:2])
        if not len(ts):
            continue
        first = np.ones(len(ts), bool)
        first[1:] = ts[1:] != ts[:-1]
        # Tokens with one row, other than at the ends of the batch, are passed over at once.
        alone = first & np.append(first[1:], False)
        if ts[0] == token:
            alone[0] = False
        rows = np.flatnonzero(~alone)
        out = []
        for t, g in zip(ts[rows].tolist(), gs[rows].tolist(), strict=True):
            if t != token:
                token, hub, last, held = t, g, g, (t, g, g)
                continue
            if g == last:
                continue  # the same group from another task
            last = g
            if held is not None:
                out.append(held)
                held = None
            if (g & 0xFFF) - (hub & 0xFFF) > MOST_STEPS:
                hub = g
            out.append((t, g, hub))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["token", "g", "hub"])


def _pair_rows(batches, most: int):
    """Counts of shared tokens of group pairs of a token whose labels differ (null: several labels): with the last
    ``most`` rows of another label, as far as signatures allow a link."""
    held: list[tuple[int, int | None, int, int | None]] = []
    token, counts = None, {}

    def flush():
        pairs = np.fromiter((x for pair in counts for x in pair), np.int64, 2 * len(counts)).reshape(-1, 2)
        shared = np.fromiter(counts.values(), np.int64, len(counts))
        counts.clear()
        return _pair_batch(pairs[:, 0], pairs[:, 1], shared)

    for batch in batches:
        for t, g, label, n, sig in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bits = None if sig is None else int.from_bytes(sig, "little")
            if t != token:
                token, held = t, []
            step = g & 0xFFF
            # Rows are sorted by size: those too small for this one are too small for all that follow.
            while held and step - (held[0][0] & 0xFFF) > MOST_STEPS:
                held.pop(0)
            left = most
            for other, its, m, those in reversed(held):
                if other != g and (label is None or its is None or label != its):
                    if bits is None or those is None or 9 * (bits ^ those).bit_count() <= n + m:
                        pair = (min(g, other), max(g, other))
                        counts[pair] = counts.get(pair, 0) + 1
                        if len(counts) >= HELD_PAIRS:
                            yield flush()
                    left -= 1
                    if not left:
                        break
            held.append((g, label, n, bits))
            if len(held) > 8 * most:
                held.pop(0)
    yield flush()


def _pair_batch(a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (a, b, shared)], names=["a", "b", "shared"])


def _token_rows(batches, wanted):
    """Complete sets (6 bytes a shingle) of the documents whose bit is set in ``wanted``."""
    bits = np.unpackbits(np.frombuffer(wanted, np.uint8))
    for batch in batches:
        ids = np.array([0 if x is None else x for x in batch.column(0).to_pylist()], np.int64)
        hit = np.flatnonzero(bits[_slot(ids)])
        if not len(hit):
            continue
        some = batch.take(pa.array(hit))
        for a, b, sets in _sets(some):
            flat, starts = _flat(sets)
            # The order of the cut hashes is the order of the hashes, so the sets stay sorted.
            cut = [(s >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0).slice(a, b - a), pa.array(_first_ids(flat, starts)), pa.array(cut, pa.binary()),
                    pa.array([_signature(s) for s in sets], pa.binary()),
                ],
                names=["doc_id", "s1", "tokens", "sig"],
            )


def _signature(hashes: np.ndarray) -> bytes:
    """Bit k is the parity of the number of shingles that fall on k."""
    at = (mix(hashes) >> np.uint64(32)).astype(np.int64) % SIGNATURE_BITS
    return np.packbits((np.bincount(at, minlength=SIGNATURE_BITS) & 1).astype(np.uint8)).tobytes()


def _cell_rows(batches):
    """Counts of shared tokens of group pairs that may link, cell by cell.

    Rows (token, i, j, block, g, label, n, sig) come sorted by cell (token, i, j). Pairs are those of block i with block j whose labels
    differ (null: several), whose sizes can link and whose signatures allow it (null: not known). A cell has
    two blocks at most.
    """
    key, held, used = None, [], 0
    made = np.empty((2 * HELD_PAIRS, 2), np.int64)

    def flush():
        pairs = made[:used][np.lexsort((made[:used, 1], made[:used, 0]))]
        first = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1))[:used])
        return _pair_batch(pairs[first, 0], pairs[first, 1], np.diff(np.append(first, used)))

    def cells():
        nonlocal key, held
        for batch in batches:
            for *cell, block, g, label, n, sig in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if cell != key:
                    yield key, held
                    key, held = cell, []
                held.append((block, g, label, n, sig))
        yield key, held

    for cell in cells():
        for pairs in _cell_pairs(*cell):
            if used + len(pairs) > len(made):
                yield flush()
                used = 0
            made[used : used + len(pairs)] = pairs
            used += len(pairs)
    yield flush()


def _cell_pairs(key, held) -> Iterator[np.ndarray]:
    """The group pairs (smaller, larger) of one cell, some at a time; each once."""
    if key is None or len(held) < 2:
        return
    _, i, j = key
    block, g, n = (np.array([h[k] for h in held], np.int64) for k in (0, 1, 3))
    label = np.array([0 if h[2] is None else h[2] for h in held], np.int64)
    several = np.array([h[2] is None for h in held])
    known = np.array([h[4] is not None for h in held])
    blank = bytes(SIGNATURE_BITS // 8)
    sig = np.frombuffer(b"".join(h[4] or blank for h in held), np.uint64).reshape(len(held), -1)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    for a in range(0, len(left), 128):
        some = left[a : a + 128]
        apart = (label[some, None] != label[None, right]) | several[some, None] | several[None, right]
        small, large = np.minimum(n[some, None], n[None, right]), np.maximum(n[some, None], n[None, right])
        apart &= (5 * small >= 4 * large) & (g[some, None] != g[None, right])
        if i == j:
            apart &= some[:, None] < right[None, :]
        x, y = np.nonzero(apart)
        x, y = some[x], right[y]
        for c in range(0, len(x), 1 << 14):
            p, q = x[c : c + (1 << 14)], y[c : c + (1 << 14)]
            differ = np.bitwise_count(sig[p] ^ sig[q]).sum(axis=1, dtype=np.int64)
            keep = (9 * differ <= n[p] + n[q]) | ~known[p] | ~known[q]
            u, v = g[p[keep]], g[q[keep]]
            if len(u):
                yield np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1)


def _slot(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _mark(table: np.ndarray, batch: pa.RecordBatch) -> None:
    table[_slot(batch.column(0).to_numpy(zero_copy_only=False))] = 1


def _read(data: bytes) -> np.ndarray:
    raw = np.zeros((len(data) // 6, 8), np.uint8)
    raw[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return raw.view("<u8").ravel()


def _verify(batches):
    for batch in batches:
        a, b, x, y = (batch.column(i) for i in range(4))
        keep = []
        for i in range(batch.num_rows):
            p, q = _read(x[i].as_py()), _read(y[i].as_py())
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(9 * both >= 4 * (len(p) + len(q)))
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


# ---------------------------------------------------------------- the join


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    levels = rarity(rows)
    found = materialize(
        rows.mapInArrow(lean(lambda b: _document_rows(b, levels)), "doc_id long, n long, s1 long, s2 long, g long"), "join-documents"
    )
    known = found.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # One member per distinct set; copies are pre-aggregated wherever they lie.
    sets = materialize(known.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("g").alias("g")), "join-sets")
    members = sets.select("g", "rep", "s1", "n")

    postings = rows.mapInArrow(lean(lambda b: _posting_rows(b, levels)), "token long, g long")
    postings = postings.repartition(F.col("token")).sortWithinPartitions("token", F.col("g").bitwiseAND(0xFFF), "g")
    shared = materialize(postings.mapInArrow(lean(_hub_rows), "token long, g long, hub long"), "join-shared")

    lead = members.groupBy("g").agg(F.min("rep").alias("lead"), F.count("*").alias("_n"), F.min("n").alias("n"))
    lead = materialize(lead, "join-groups")
    # Groups that share too little to link outside leave; members of one group are compared with each other.
    able = materialize(_able(shared, lead), "join-able")
    shared = materialize(shared.join(able, "g", "left_semi"), "join-shared")
    wide = lead.where(F.col("_n") > 1).select("g").unionByName(able).distinct()
    wanted = members.join(wide, "g", "left_semi").select("rep")
    bits = np.packbits(_gather(wanted, _mark, 1 << FILTER_BITS, "or") > 0).tobytes()
    tokens = materialize(rows.mapInArrow(lean(lambda b: _token_rows(b, bits)), "doc_id long, s1 long, tokens binary, sig binary"), "join-tokens")

    hubs = shared.where(F.col("g") != F.col("hub")).groupBy("g", "hub").agg(F.count("*").alias("_shared"))
    hubs = _enough(hubs.select(F.col("g").alias("a"), F.col("hub").alias("b"), "_shared"), lead, part=2)
    # All members of a group against the first of the hub group and of their own.
    first = members.join(lead.select("g", "lead"), "g").join(sets.select(F.col("rep").alias("lead"), F.col("g"), F.col("s1").alias("_s")), ["lead", "g"])
    inside = first.where(F.col("rep") != F.col("lead")).select("rep", "s1", F.col("lead").alias("to"), F.col("_s").alias("to_s1"))
    heads = lead.select(F.col("g").alias("b"), F.col("lead").alias("to")).join(sets.select(F.col("rep").alias("to"), F.col("g").alias("b"), F.col("s1").alias("to_s1")), ["to", "b"])
    outside = members.join(hubs.select(F.col("a").alias("g"), "b"), "g").join(heads, "b").select("rep", "s1", "to", "to_s1")
    tried = materialize(inside.unionByName(outside).distinct(), "join-tried")
    links = materialize(_verified(tried, tokens), "join-links")
    roots = components(links)

    signed = tokens.select(F.col("doc_id").alias("rep"), "s1", "sig")
    settled = False
    for turn in range(ROUNDS + 1):
        if settled and turn < ROUNDS:
            continue  # neighbours have nothing more to connect
        most = NEIGHBOURS if turn < ROUNDS else 0
        with scratch(docs.sparkSession) as keep:
            label = members.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
            label = materialize(label, "join-labels")
            of_group = label.groupBy("g").agg(F.min("root").alias("_a"), F.max("root").alias("_b"))
            of_group = materialize(of_group.select("g", F.when(F.col("_a") == F.col("_b"), F.col("_a")).alias("label")), "join-group-labels")
            wider, shared = shared, keep(materialize(_open_rows(shared, of_group, lead), "join-open"))
            discard(wider)
            label = materialize(label.join(signed, ["rep", "s1"], "left"), "join-signed")
            pairs = _neighbour_pairs(shared, label, lead, turn, most) if most else _all_pairs(shared, label, lead)
            mixed = of_group.where(F.col("label").isNull()).select(F.col("g").alias("a"), F.col("g").alias("b"))
            fresh = _member_pairs(pairs.unionByName(mixed), label)
            fresh = fresh.join(tried, ["rep", "s1", "to", "to_s1"], "left_anti")
            fresh = fresh.join(tried.select(F.col("rep").alias("to"), F.col("s1").alias("to_s1"), F.col("to").alias("rep"), F.col("to_s1").alias("s1")), ["rep", "s1", "to", "to_s1"], "left_anti")
            fresh = keep(materialize(fresh, "join-tried"))
            tried = tried.unionByName(fresh)
            late = keep(materialize(_verified(fresh, tokens), "join-links"))
        settled = late.isEmpty()
        if not settled:
            links = links.unionByName(late)
            roots = components(links)

    of_set = sets.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select("n", "s1", "s2", F.coalesce("root", "rep").alias("_root"))
    out = found.join(of_set, ["n", "s1", "s2"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("_root"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _able(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The groups that have enough rows (token, g) to link with another: l(n) of the smallest set that can link with them."""
    counts = rows.groupBy("g").agg(F.count("*").alias("_shared")).join(groups.select("g", "n"), "g")
    return counts.where(F.col("_shared") >= 1 + F.floor(F.floor(F.col("n") * 4 / 5) / 20)).select("g")


def _open_rows(shared: DataFrame, of_group: DataFrame, groups: DataFrame) -> DataFrame:
    """(token, g, label) of the tokens that have groups of different labels; a null label is one of several.

    Groups with too few such tokens leave, and tokens that lose all but one of their groups with them.
    """
    rows = shared.select("token", "g").join(of_group, "g")
    for last in (False, True):
        ends = rows.groupBy("token").agg(F.min("label").alias("_a"), F.max("label").alias("_b"), F.count("*").alias("_n"), F.count("label").alias("_k"))
        wanted = ends.where((F.col("_n") > 1) & ((F.col("_k") < F.col("_n")) | (F.col("_a") != F.col("_b")))).select("token")
        rows = rows.join(wanted, "token", "left_semi").select("token", "g", "label")
        if not last:
            rows = materialize(rows, "join-open-tokens")
            rows = rows.join(_able(rows, groups), "g", "left_semi")
    return rows


def _signed_groups(label: DataFrame) -> DataFrame:
    """(g, n, sig): a group of one set has that set's signature, others have none."""
    sets = label.groupBy("g").agg(F.count("*").alias("_k"), F.max("sig").alias("sig"), F.max("n").alias("n"))
    return sets.select("g", "n", F.when(F.col("_k") == 1, F.col("sig")).alias("sig"))


def _neighbour_pairs(rows: DataFrame, label: DataFrame, groups: DataFrame, turn: int, most: int) -> DataFrame:
    """Group pairs (a, b) of neighbours in a random order of each token's groups of one size, another in every turn."""
    rows = rows.join(_signed_groups(label), "g").repartition(F.col("token"))
    rows = rows.sortWithinPartitions("token", F.col("g").bitwiseAND(0xFFF), F.xxhash64("g", F.lit(turn)))
    pairs = rows.select("token", "g", "label", "n", "sig").mapInArrow(lean(lambda b: _pair_rows(b, most)), "a long, b long, shared long")
    return _enough(pairs.groupBy("a", "b").agg(F.sum("shared").alias("_shared")), groups, part=2).select("a", "b")


def _all_pairs(rows: DataFrame, label: DataFrame, groups: DataFrame) -> DataFrame:
    """All group pairs (a, b) that are not connected, share enough and may link by their signatures."""
    of_token = Window.partitionBy("token")
    place = F.row_number().over(of_token.orderBy(F.col("g").bitwiseAND(0xFFF), "g")) - 1
    rows = rows.withColumn("block", F.floor(place / BLOCK).cast("int")).withColumn("_last", F.max("block").over(of_token))
    # Signatures are many times wider than the rest of a row: rows get theirs once they have their places, and move once with them.
    rows = rows.join(_signed_groups(label), "g")
    cell = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_last"))))
    cell = cell.withColumns({"i": F.least("block", "_o"), "j": F.greatest("block", "_o")})
    cell = cell.repartition(F.col("token"), F.col("i"), F.col("j")).sortWithinPartitions("token", "i", "j", "g")
    pairs = cell.select("token", "i", "j", "block", "g", "label", "n", "sig").mapInArrow(lean(_cell_rows), "a long, b long, shared long")
    return _enough(pairs.groupBy("a", "b").agg(F.sum("shared").alias("_shared")), groups, part=1).select("a", "b")


def _member_pairs(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Unconnected member pairs (rep, s1, to, to_s1) of group pairs that their signatures allow."""
    words = range(SIGNATURE_BITS // 64)
    # A signature becomes numbers once per row, not once per pair.
    one = label.select(F.col("g").alias("a"), "rep", "s1", F.col("root").alias("_ra"), F.col("n").alias("_na"), *(_word(k).alias(f"_a{k}") for k in words))
    two = label.select(
        F.col("g").alias("b"), F.col("rep").alias("to"), F.col("s1").alias("to_s1"), F.col("root").alias("_rb"), F.col("n").alias("_nb"), *(_word(k).alias(f"_b{k}") for k in words)
    )
    pairs = pairs.join(one, "a")
    apart = (pairs["b"] == two["b"]) & (F.col("_ra") != F.col("_rb")) & ((F.col("a") != two["b"]) | (F.col("rep") < F.col("to")))
    differ = sum((F.bit_count(F.col(f"_a{k}").bitwiseXOR(F.col(f"_b{k}"))) for k in words), F.lit(0))
    apart = apart & F.coalesce(differ * 9 <= F.col("_na") + F.col("_nb"), F.lit(True))
    return pairs.join(two, apart).select("rep", "s1", "to", "to_s1").distinct()


def _word(k: int) -> Column:
    """Word ``k`` of 64 bits of a signature."""
    return F.conv(F.hex(F.substring("sig", 8 * k + 1, 8)), 16, -10).cast("long")


def _enough(pairs: DataFrame, groups: DataFrame, part: int) -> DataFrame:
    """Group pairs that share enough prefix shingles (a ``part`` of it) and whose sizes can link."""
    size = groups.select("g", "n")
    pairs = pairs.join(size.select(F.col("g").alias("a"), F.col("n").alias("_na")), "a").join(size.select(F.col("g").alias("b"), F.col("n").alias("_nb")), "b")
    less, most = F.least("_na", "_nb"), F.greatest("_na", "_nb")
    return pairs.where((less * 5 >= most * 4) & (F.col("_shared") * part >= 1 + F.floor(less / 20)))


def _verified(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """The pairs (rep, s1, to, to_s1), a written table, that link by their complete sets. Only sets of documents in
    ``pairs`` are dealt out: a fixed-size table of their ids passes them."""
    ids = pairs.select("rep").unionByName(pairs.select(F.col("to").alias("rep")))
    bits = np.packbits(_gather(ids, _mark, 1 << FILTER_BITS, "or") > 0).tobytes()
    some = tokens.select("doc_id", "s1", "tokens").mapInArrow(lean(lambda b: _passed(b, bits)), "doc_id long, s1 long, tokens binary")
    one = some.select(F.col("doc_id").alias("rep"), "s1", F.col("tokens").alias("x"))
    two = some.select(F.col("doc_id").alias("to"), F.col("s1").alias("to_s1"), F.col("tokens").alias("y"))
    both = pairs.join(one, ["rep", "s1"]).join(two, ["to", "to_s1"]).select(F.col("rep").alias("a"), F.col("to").alias("b"), "x", "y")
    return both.mapInArrow(lean(_verify), "a long, b long")


def _passed(batches, wanted):
    bits = np.unpackbits(np.frombuffer(wanted, np.uint8))
    for batch in batches:
        ids = pc.fill_null(batch.column(0), 0).to_numpy()
        yield batch.filter(pa.array(bits[_slot(ids)].astype(bool)))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay when one of each component does: the smallest doc_id, and rows with a null doc_id.

    Of rows that share the kept doc_id all stay. The columns are those of ``docs``.
    """
    out = link(docs).where(F.col("component_id").isNotNull() & (F.col("doc_id") != F.col("component_id"))).select("doc_id").distinct()
    return docs.join(out, "doc_id", "left_anti")

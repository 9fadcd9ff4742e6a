"""The n-gram join against all pairs in plain Python."""

import itertools
import random
import re

import numpy as np
import pytest

from footfall.llm import ngram_join
from footfall.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n long, g string, root string"


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(rows):
    """Sorted (doc_id, n, component) with rows of one id as one document."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, len(s), (i if not s else find(i)) if i is not None else None) for i, s in sets), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], DOCS)
    return sorted((tuple(r) for r in ngram_join.link(df).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_edge_cases(spark):
    base = "a b c d e f g h i j k l m n o p"
    rows = [
        (9, None), (8, ""), (7, " \t"), (6, "one two"), (5, "ONE  two"), (4, "one two three"), (3, base), (2, base + " q"), (1, base.upper()),
        (None, base), (10, base), (10, base), (11, "É b"), (12, "é b"), (13, "x " * 3000), (14, "x " * 4000), (15, "\x1c"),
    ]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("seed", range(3))
def test_random_near_copies(spark, seed):
    rng = random.Random(seed)
    bases = [[f"w{rng.randint(0, 60)}" for _ in range(rng.randint(3, 90))] for _ in range(12)]
    rows = []
    for i in range(260):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(words))
            if rng.random() < 0.5:
                words[k] = f"w{rng.randint(0, 60)}"
            else:
                words[k:k] = [f"w{rng.randint(0, 60)}"]
        rows.append((i * 7 % 263, " ".join(words)))
    assert run(spark, rows) == plain(rows)


def test_a_family_of_loose_copies(spark, monkeypatch):
    """Copies that are mostly just too far apart: the right components, and few pairs leave the last comparison."""
    rng = random.Random(6)
    base = [f"b{rng.randint(0, 10**6)}" for _ in range(170)]
    rows = []
    for i in range(600):
        words = list(base)
        for _ in range(rng.randint(1, 9)):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 10**9)}"
        rows.append((i, " ".join(words)))
    made = []
    whole = ngram_join._all_pairs

    def counted(*args):
        pairs = whole(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "_all_pairs", counted)
    monkeypatch.setattr(ngram_join, "BLOCK", 50)
    want = plain(rows)
    assert run(spark, rows) == want
    assert 20 < len({c for *_, c in want}) < 580
    assert made and made[0] < 25_000  # of 180,000


def test_signatures_only_exclude():
    rng = random.Random(9)
    for _ in range(200):
        n, m = rng.randint(1, 400), rng.randint(1, 400)
        shared = rng.randint(0, min(n, m))
        words = [rng.getrandbits(64) for _ in range(n + m - shared)]
        a, b = np.array(words[:n], np.uint64), np.array(words[n - shared :], np.uint64)
        apart = int(np.bitwise_count(np.frombuffer(ngram_join._signature(a), np.uint64) ^ np.frombuffer(ngram_join._signature(b), np.uint64)).sum())
        assert apart <= n + m - 2 * shared


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert run(spark, rows) == plain(rows)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_all_pairs_moves_signatures_once(spark):
    """Of the exchanges of the last comparison only the one that deals the cells carries whole rows' signatures."""
    rows = spark.createDataFrame([(t, g, None) for t in range(3) for g in range(4096, 4100)], "token long, g long, label long")
    label = spark.createDataFrame([(g, g, g, 100, bytes(128), g) for g in range(4096, 4100)], "g long, rep long, s1 long, n long, sig binary, root long")
    groups = label.select("g", "n")
    pairs = ngram_join._all_pairs(rows, label, groups)
    lines = pairs._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    below = list(itertools.takewhile(lambda line: depth(line) > depth(lines[window]), lines[window + 1 :]))
    assert below and not any("sig" in line for line in below)
    assert pairs.count() == 0  # two shared shingles are too few for sets of 100


def test_rows_for_python_are_bounded_by_bytes(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    ngram_join.link(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")).collect()
    docs = spark.createDataFrame([(k, "x" * 1_000_000) for k in range(20)], "doc_id long, text string").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield b.from_arrays([[b.nbytes]], names=["n"])

    assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < 6_000_000


def test_pairs_of_a_cell_are_held_in_little_memory():
    """A full cell of groups that may all link gives each pair once, and no table of all its pairs in Python."""
    import tracemalloc

    import pyarrow as pa

    n = ngram_join.BLOCK
    names = ["token", "i", "j", "block", "g", "label", "n", "sig"]
    cell = [[7] * n, [0] * n, [0] * n, [0] * n, [k << 12 | 640 for k in range(n)], list(range(n)), [1000] * n, [None] * n]
    kinds = [pa.int64()] * 7 + [pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cell, kinds, strict=True)], names=names)
    tracemalloc.start()
    sizes = [out.num_rows for out in ngram_join._cell_rows(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == n * (n - 1) // 2
    assert max(sizes) <= 2 * ngram_join.HELD_PAIRS
    assert peak < 60 << 20
    twice = pa.Table.from_batches([batch.slice(0, 3), batch.slice(0, 3).set_column(0, "token", pa.array([8] * 3))]).to_batches()
    (out,) = ngram_join._cell_rows(iter(twice))
    assert out.column("shared").to_pylist() == [2, 2, 2]


def test_workers_give_memory_back(monkeypatch):
    from footfall import session

    calls = []
    monkeypatch.setattr(session, "give_back", lambda: calls.append(1))
    assert list(session.lean(lambda batches: (x + 1 for x in batches))(iter([1, 2]))) == [2, 3] and len(calls) == 1
    assert session.given_back("x") == "x" and len(calls) == 2

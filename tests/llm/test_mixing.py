"""Mixing: targets against plain resharing, rounding by its invariants and over many seeds."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from footfall.llm import mixing

DOCS = "doc_id long, text string, source string, size string, leaf int, target string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS).repartition(parts)


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what is above the cap is reshared among the others until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if share[s] > most * sizes[s]}
        if not over:
            return {**{s: float(most * sizes[s]) for s in capped}, **share}
        capped |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("seed", range(2))
def test_targets_sums_and_bounds(spark, seed):
    rng = random.Random(seed)
    sources = ["a", "b", "Z", "é", "", None, "tiny", "also tiny", "none"]
    rows = []
    for i in range(900):
        source = rng.choice(sources[:6]) if i > 12 else sources[6 + i % 2]
        n = 0 if i % 50 == 0 else rng.choice([1, 2, 3, 10, 40, rng.randint(1, 300)])
        rows.append((rng.choice([None, 5, i]), " ".join("w" * rng.randint(1, 3) for _ in range(n)), source))
    rows += [(1000, None, "none"), (1001, " \t\n", "none"), (1002, "x " * 200_000, "a")]
    got = [tuple(r) for r in mixing.plan(frame(spark, rows), leaf_rows=16, fan=4).collect()]
    assert Counter((i, s, n) for i, s, n, *_ in got) == Counter((i, s, words(t)) for i, t, s in rows)
    size, taken, biggest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, s, n, source_size, target, copies, k in got:
        size[s] += n
        taken[s] += k
        biggest[s] = max(biggest[s], n)
        assert k == copies * n and copies <= 3
        assert not source_size or copies in (int(target / source_size), int(target / source_size) + 1)
    want = plain_targets(size)
    for i, s, n, source_size, target, *_ in got:
        assert source_size == size[s] and target == pytest.approx(want[s], rel=1e-12)
    assert any(want[s] == 3 * size[s] for s in want if size[s])
    for s in want:
        assert abs(taken[s] - want[s]) <= biggest[s]
    again = [tuple(r) for r in mixing.plan(frame(spark, rows[::-1], 7), leaf_rows=16, fan=4).collect()]
    assert Counter(map(repr, again)) == Counter(map(repr, got))


def test_rounding_keeps_expectations_and_words():
    rng = random.Random(3)
    rows = [("s", 0, i, n, n * p) for i, (n, p) in enumerate((rng.randint(1, 50), rng.uniform(0.05, 0.95)) for _ in range(12))]
    rows.sort(key=lambda r: -r[3])
    schema = pa.schema([("source", pa.string()), ("leaf", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int64()), ("words", pa.float64())])
    parts = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:b]), schema.types)], schema=schema) for a, b in ((0, 5), (5, 12))]
    hits, runs = Counter(), 6000
    for seed in range(runs):
        out = [r for b in mixing._round(iter(parts), seed, 0, True) for r in b.to_pylist()]
        assert sorted(r["doc_id"] for r in out) == list(range(12))
        hits.update(r["doc_id"] for r in out if r["extra"])
        if seed < 300:
            (open_row,) = [r for b in mixing._round(iter(parts), seed, 0, False) for r in b.to_pylist() if r["extra"] is None] or [None]
            total = sum(r["size"] * r["extra"] for r in out)
            assert abs(total - sum(r[4] for r in rows)) <= (open_row["size"] if open_row else 1e-6)
    for _, _, i, n, x in rows:
        assert abs(hits[i] / runs - x / n) < 0.035


def test_the_mix_itself(spark):
    rows = [(i % 7, f"{'w ' * (i % 5)}t{i % 3}", "ab"[i % 2] if i % 11 else None) for i in range(60)]
    docs = frame(spark, rows)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    plan = [r.asDict() for r in mixing.plan(docs).collect()]
    key = lambda r: (r["doc_id"], r["source"])
    want = Counter()
    for r in plan:
        want[key(r), r["size"]] += r["copies"]
    assert Counter((key(r), words(r["text"])) for r in out.collect()) == +want


def test_empty_tables(spark):
    none = frame(spark, [])
    assert mixing.digest(none).collect() == [] and mixing.mix(none).collect() == []
    rows = [tuple(r) for r in mixing.digest(frame(spark, [(1, "", "a"), (2, None, None)])).collect()]
    assert sorted(rows) == [(1, 0, 0, 0.0, 0, 0), (2, 0, 0, 0.0, 0, 0)]

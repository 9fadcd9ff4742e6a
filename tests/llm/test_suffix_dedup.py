"""Repeated passages against a plain dictionary of all 50-byte strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from footfall.llm import suffix_dedup
from footfall.llm.words import running, BYTE_CODE, mix

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, part int, c0 string, n_chars long"


def plain(rows):
    first = {}
    order = lambda i: (i is None, i or 0)
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for k in range(len(b) - 49):
            g = b[k : k + 50]
            first[g] = min(first.get(g, order(i)), order(i))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < order(i):
                gone[k : k + 50] = b"\1" * 50
        spans = sum(x and not (k and gone[k - 1]) for k, x in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", 5) for r in rows], DOCS)


def run(spark, rows):
    return sorted((str(r[0]), *r[1:]) for r in suffix_dedup.digest(frame(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def test_edge_cases(spark):
    rng = random.Random(2)
    p = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = [
        (1, None), (2, ""), (3, p[:49]), (4, p[:50]), (5, "x" + p[:50]), (6, p), (7, p[100:160] + "Q" + p[101:160]), (8, p[10:59]),
        (9, "é" * 40), (10, "aé" + "é" * 40), (11, "z" * 3000), (12, "z" * 70 + "y" + "z" * 49), (13, "z" * 200), (13, p[:120]), (13, p[:120]),
        (None, p[200:280]), (None, "w" * 90), (None, "w" * 90), (20, p + p), (0, p[120:175]), (21, "ab" * 400), (22, "ba" * 300),
    ]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("seed", range(4))
def test_random_overlaps(spark, monkeypatch, seed):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 3000)
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab c") for _ in range(rng.randint(20, 400))) for _ in range(8)]
    rows = []
    for i in range(90):
        text = "".join(p[rng.randint(0, len(p) // 2) : rng.randint(len(p) // 2, len(p))] for p in rng.choices(pool, k=rng.randint(0, 4)))
        rows.append((rng.randint(0, 70), text))
    assert run(spark, rows) == plain(rows)


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert run(spark, rows) == plain(rows)


def test_clean_keeps_columns(spark):
    p = "ü" * 60
    rows = [(1, p), (2, "x" + p + "end"), (3, None)]
    out = suffix_dedup.clean(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "part", "c0", "n_chars"]
    assert sorted((r["doc_id"], r["text"], r["n_chars"], r["c0"]) for r in out.collect()) == [(1, p, 60, "clash"), (2, "xend", 4, "clash"), (3, "", 0, "clash")]


def test_equal_strings_share_an_anchor():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 1200, 1230, 1230, 5000])
    row, lo, n, anchor, *_ = suffix_dedup.runs(data, offsets)
    sums, down = running(BYTE_CODE[data])
    seen, strings = {}, 0
    for r, a, k, key in zip(row.tolist(), lo.tolist(), n.tolist(), anchor.tolist()):
        for s in range(a, a + k):
            g = data[offsets[r] + s : offsets[r] + s + 50].tobytes()
            assert len(g) == 50 and offsets[r] + s + 50 <= offsets[r + 1]
            assert seen.setdefault(g, key) == key
            strings += 1
    assert strings == sum(max(0, b - a - 49) for a, b in zip(offsets[:-1], offsets[1:]))
    assert mix(np.array([1], np.uint64))[0] != 1


def batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["doc_id", "text"])


def test_covers_are_compared_whole(monkeypatch):
    """Covers that agree in their low 32 bits are not equal."""
    whole = suffix_dedup.runs

    def alike(data, offsets):
        row, lo, n, anchor, cover, left, right = whole(data, offsets)
        return row, lo, n, anchor, cover & ~np.uint64(0xFFFFFFFF), left, right

    monkeypatch.setattr(suffix_dedup, "runs", alike)
    rng = random.Random(4)
    line = "".join(rng.choice("abcdefgh ") for _ in range(53))
    rows = [(i, "".join(rng.choice("stuvwxyz") for _ in range(80)) + line + "".join(rng.choice("stuvwxyz") for _ in range(80))) for i in range(20)]
    found = pa.Table.from_batches(list(suffix_dedup._run_rows([batch(rows)], 1)))
    marks = suffix_dedup._by_document(suffix_dedup._rank_runs(found, 1))
    for key, (lo, n, decided, _) in marks.items():
        for a, k in zip(lo[decided].tolist(), n[decided].tolist()):
            assert line[a - 80 :].startswith(rows[key[0]][1][a : a + k + 49]), "a passage with its own context was removed"
    assert any((~decided).any() for _, _, decided, _ in marks.values())


def common_line(rng, n):
    line = "".join(rng.choice("abcdefgh ") for _ in range(120))
    other = lambda k: "".join(rng.choice("stuvwxyz") for _ in range(k))
    return [(i if i % 50 else None, other(rng.randint(30, 90)) + line[rng.randint(0, 9) :] + other(rng.randint(30, 90))) for i in rng.sample(range(n), n)]


def test_no_bucket_holds_every_document_of_an_anchor():
    rows = common_line(random.Random(5), 800)
    batches = [batch(rows[a : a + 100]) for a in range(0, 800, 100)]
    counts = [b for x in batches for b in suffix_dedup._anchor_counts(iter([x.select(["text"])]), 4)]
    times = {}
    for b in counts:
        for anchor, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            times[anchor] = times.get(anchor, 0) + n
    hot = np.sort(np.array([a for a, n in times.items() if n > 200], np.int64).view(np.uint64))

    def largest(hot):
        found = pa.Table.from_batches([b for x in batches for b in suffix_dedup._run_rows(iter([x]), 64, hot)])
        held = {}
        for bucket, kind, doc in zip(*(found.column(c).to_pylist() for c in ("bucket", "kind", "doc"))):
            held[bucket] = held.get(bucket, 0) + len(doc) // 4 * (kind != suffix_dedup.DECIDED)
        return found, max(held.values()) / sum(held.values())

    assert len(hot) and largest(hot[:0])[1] > 0.09
    found, share = largest(hot)
    assert share < 0.03
    strings = found.filter(pc.equal(found.column("kind"), suffix_dedup.STRING))
    rank = suffix_dedup._join(strings.column("rank").to_pylist(), 8)
    assert np.unique(rank, return_counts=True)[1].max() <= 2 * len(batches)  # once per batch, twice where its smallest document has it twice


@pytest.mark.parametrize("seed", range(2))
def test_hot_anchors(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", 30)
    copy = "".join(rng.choice("ijkl ") for _ in range(700))
    rows = common_line(rng, 300) + [(rng.randint(0, 400), copy[rng.choice([0, 0, 0, 35]) :]) for _ in range(60)]
    rows += [(7, "-" * 200), (8, "-" * 90), (9, "-" * 400 + "x"), (None, "-" * 60)]
    assert len(suffix_dedup.hot_anchors(frame(spark, rows))) > 3
    assert run(spark, rows) == plain(rows)


def test_a_task_holds_a_few_megabytes_at_once():
    """Runs leave a task every few megabytes of text, and so much text makes a bucket: two tasks of an executor fit beside its heap."""
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, 4096, np.uint8).tobytes().decode() for _ in range(5000)]
    batches = [batch([(1000 * k + i, t) for i, t in enumerate(texts[1000 * k : 1000 * (k + 1)])]) for k in range(5)]
    out = list(suffix_dedup._run_rows(batches, suffix_dedup.buckets_for(20 << 20)))
    assert max(b.nbytes for b in out) < 20 << 20
    assert suffix_dedup.buckets_for(64 << 20) >= 8

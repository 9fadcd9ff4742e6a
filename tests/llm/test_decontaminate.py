"""Spaced seeds against every alignment in plain Python."""

import random
import re
from itertools import combinations

from footfall.llm import decontaminate as D

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, item_id long, seed long, _row long"


def plain_words(t):
    return re.findall(r"[\u3040-\u30ff\u4e00-\u9fff\u0e00-\u0e2e]|[^\W_\u3040-\u30ff\u4e00-\u9fff\u0e00-\u0e2e]+", (t or "").lower())


def plain(rows, items):
    out = set()
    for item, t in items:
        w = plain_words(t)
        if not w:
            continue
        n = min(len(w), D.WINDOW)
        most = 3 if len(w) >= 15 else 1 if len(w) >= 8 else 0
        for doc, text in rows:
            d = plain_words(text)
            for shift in range(-len(w) + 1, len(d)):
                e = [0 <= shift + q < len(d) and d[shift + q] == x for q, x in enumerate(w)]
                if any(sum(e[s : s + n]) >= n - most for s in range(len(w) - n + 1)):
                    out.add((doc, item))
                    break
    return out


def run(spark, rows, items):
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], DOCS)
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    got = D.contaminated(docs, bench).collect()
    pairs = [(r["doc_id"], r["item_id"]) for r in got]
    assert len(pairs) == len(set(pairs))
    kept = sorted(str(r["doc_id"]) for r in D.clean(docs, bench).collect())
    return set(pairs), kept


def test_masks_are_lossless():
    for n, most in [(15, 3), *((k, 1) for k in range(8, 15)), *((k, 0) for k in range(5, 8))]:
        places = [{o + x for x in m} for m in D.MASKS for o in range(n - max(m))]
        for gaps in combinations(range(n), most):
            assert any(not p & set(gaps) for p in places)


def test_against_all_alignments(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(3, 40)))) for i in range(25)] + [(90, None), (91, ""), (92, "one two")]
    items.append(items[0])
    rows = []
    for i in range(150):
        d = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 2:
            w = plain_words(rng.choice(items)[1])
            for _ in range(rng.randint(0, 6)):
                if w:
                    w[rng.randrange(len(w))] = "sub"
            at = rng.randint(0, len(d))
            d[at:at] = [x.upper() + "," for x in w]
        rows.append((i, " ".join(d)))
    rows += [(500, None), (501, ""), (502, items[1][1]), (502, "other"), (None, items[1][1])]
    want = plain(rows, items)
    got, kept = run(spark, rows, items)
    assert got == want and want
    bad = {(d, t) for d, t in rows if plain([(d, t)], items)}
    assert kept == sorted(str(d) for d, t in rows if (d, t) not in bad)
    assert run(spark, rows[:3], []) == (set(), sorted(str(d) for d, _ in rows[:3]))
    assert run(spark, [], items) == (set(), [])


def test_short_and_unspaced_items(spark):
    items = [(1, "w3 w4"), (2, "W7, w8 w9 w10"), (3, "你好世界，今天是个好天气吗"), (4, "天气"), (5, "solo"), (6, "--"), (7, "ภาษาไทยสวย"), (8, "w1 w2 w3")]
    rows = [
        (1, "w3 w4"), (2, "w3, W4!"), (3, "w3 x w4"), (4, "w7 w8 w9 w10 w11"), (5, "w7 w8 w9 w11"), (6, "我说:你好世界,今天是个好天气吗?对"), (7, "天 气 好"),
        (8, "solos"), (9, "a solo act"), (10, "你好世界今日是个好天气吗"), (11, "ภาษาไทยสวย"), (12, "w2 w1 w3 w2"), (13, "long " * 40_000 + "w1 w2 w3 " + "tail " * 40_000),
    ]
    got, _ = run(spark, rows, items)
    assert got == plain(rows[:-1], items) | {(13, 8)}
    assert {(1, 1), (2, 1), (4, 2), (6, 3), (7, 4), (9, 5), (10, 3)} <= got


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(12).collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows += [(10_000 + i, f"before {t} after") for i, t in items[:5]]
    assert run(spark, rows, items)[0] == plain(rows, items)

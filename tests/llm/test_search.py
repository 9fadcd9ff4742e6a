"""Ranked search against plain scoring of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import search
from footfall.llm.terms import term_pieces

DOCS = "doc_id long, text string, n long, bag string, m int, score string"
ITEMS = "item_id long, text string, rank int, item string"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain(docs, items, top=20):
    bags = [(i, terms(t)) for i, t in docs]
    n_docs, size = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            if bag:
                tf, m = Counter(bag), 75 + (25 * len(bag) * n_docs) // size
                w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                s = sum(w(t) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in terms(text))
                if s > 0:
                    scores.append((-s, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in docs], DOCS).repartition(5)
    q = spark.createDataFrame([(*r, 1, "x") for r in items], ITEMS)
    return sorted((tuple(r) for r in search.rank(d, q, **options).collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_random_documents(spark, seed, monkeypatch):
    if seed:  # small steps inside a task
        monkeypatch.setattr(search, "CELLS", 64)
        monkeypatch.setattr(search, "POSTINGS", 50)
    rng = random.Random(seed)
    words = [f"W{k}" for k in range(60)] + ["é", "É", "日本", "x-y", "a_b", "9"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [text(rng.randint(1, 30)) for _ in range(60)]
    docs = [(i, rng.choice(base) if i % 3 else text(rng.randint(0, 40)) + " other" * rng.randint(0, 3)) for i in range(400)]
    docs += [(7, base[0]), (7, base[0]), (None, base[0]), (None, "W1"), (500, None), (501, ""), (502, "?! \x00"), (503, "filler " * 3000 + "W2 W2")]
    docs += [(600 + i, "w5 W6 é") for i in range(90)]  # one large class
    items = [(1, "w1 W2 w2 unknown"), (2, "W5 w6"), (3, "É 日本 x"), (4, None), (5, "nothing here"), (6, ""), (None, "w9"), (8, " ".join(words) * 3), (9, "w5"), (9, "w6")]
    want = plain(docs, items)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, block_items=3) == want


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, None)], [(1, "a")]) == []


def test_long_texts_in_pieces():
    rng = random.Random(1)
    texts = [None, "", "a b", "x" * 500, " ".join("é" * rng.randint(0, 9) + "Ab" for _ in range(400)), "-" * 300 + "z", "q" * 90 + " r"]
    for limit in (1, 7, 64, 1 << 20):
        found = [[] for _ in texts]
        for row, part in term_pieces(pa.array(["dropped", *texts], pa.string()).slice(1), limit):
            for r, t in zip(row.tolist(), part.to_pylist(), strict=True):
                found[r].append(t)
        assert found == [terms(t) for t in texts]


def test_best_keeps_ties_by_order():
    score, order = np.array([5, 0, 7, 5, 5, 5]), np.array([9, 1, 8, 2, 7, 3])
    assert search._best(score, order, 3).tolist() == [2, 3, 5]

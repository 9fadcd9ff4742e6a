"""Importance resampling against plain Python, and the cutoff against sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from footfall.llm import resample

DOCS = "doc_id long, text string, weight string, score int, rank string, a int"


def features(text, gram=1):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i : i + k]) for k in range(1, gram + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, gram=1, buckets=10_000, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for text in texts for f in features(text, gram)[1]) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows, able = [], []
    for i, text in docs:
        words, found = features(text, gram)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        if len(words) >= least:
            able.append((-score, i is None, i or 0, len(found), weight, len(rows)))
        rows.append([i, len(found), weight, score, None])
    for k, (*_, at) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        rows[at][4] = k
    return sorted(map(tuple, rows), key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in docs], DOCS).repartition(4)


def corpus(rng, n):
    words = [f"w{k}" for k in range(300)] + ["É", "日本", "Ab"]
    text = lambda m: " ".join(rng.choice(words) for _ in range(m))
    docs = [(i if i % 9 else 5, text(rng.choice([0, 5, 19, 20, 21, 40]))) for i in range(n)]
    docs += [(None, docs[3][1]), (None, "w1 " * 30), (None, "w1 " * 30), (7, "w1 " * 30), (7, "w1 " * 30), (8, None), (9, ""), (10, "w2-" * 4000), (11, "~" * 99)]
    return docs, [text(30), text(3), None, "", "w1 w2 W3"]


@pytest.mark.parametrize("gram,few", [(1, 4096), (1, 3), (2, 16)])
def test_draw(spark, gram, few, monkeypatch):
    monkeypatch.setattr(resample, "CHUNK", 16)
    monkeypatch.setattr(resample.cutoff, "__defaults__", (few,))
    docs, target = corpus(random.Random(few), 400)
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resample.draw(frame(spark, docs), goal, gram=gram)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, target, gram)


def test_empty_tables_and_all_drawn(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert resample.draw(frame(spark, []), empty).collect() == []
    docs, _ = corpus(random.Random(4), 50)
    assert sorted((tuple(r) for r in resample.draw(frame(spark, docs), empty, percent=100).collect()), key=repr) == plain(docs, [], percent=100)
    kept = resample.keep_drawn(frame(spark, docs), empty, percent=100)
    ids = {r[0] for r in plain(docs, [], percent=100) if r[4]}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, _ in docs if i in ids)


@pytest.mark.parametrize("chunk,group", [(8, 4096), (8, 3), (1000, 4096)])
def test_cutoff_is_the_sorted_key(spark, monkeypatch, chunk, group):
    monkeypatch.setattr(resample, "CHUNK", chunk)
    plain_sides = resample._sides
    monkeypatch.setattr(resample, "_sides", lambda keys, pivot, total: plain_sides(keys, pivot, total, group))
    rng = random.Random(chunk + group)
    keys = [(rng.randint(-5, 5), rng.randint(0, 40)) for _ in range(700)] + [(1, 1)] * 100
    df = spark.createDataFrame(keys, "a long, b long").repartition(5)
    for k in (1, 350, len(keys)):
        assert resample.cutoff(df, k, len(keys), few=5) == sorted(keys)[k - 1]
    assert resample.cutoff(df, 0, len(keys)) is None

"""Hierarchical classification on a hand-made tree."""

import pytest
from pyspark.sql import functions as F

from footfall.operators import classify

ROWS = [
    ("the match was won by a late goal", "sport", "football"), ("goal goal the keeper saved a goal", "sport", "football"), ("a goal in the last minute", "sport", "football"),
    ("the player served an ace on court", "sport", "tennis"), ("ace and set on the tennis court", "sport", "tennis"), ("court serve ace volley", "sport", "tennis"),
    ("股票市场今天上涨", "money", None), ("今天股票下跌", "money", None), ("市场股票基金上涨", "money", None),
    ("shares fell", "money", "stocks"), ("shares rose on the market", "money", "stocks"), ("market shares bonds", "money", "stocks"),
]


def test_weights_and_best_leaves(spark):
    labelled = spark.createDataFrame(ROWS, "text string, top string, sub string")
    tree = classify.fit_tree(labelled, ["top", "sub"], features=1 << 10)
    assert [(n.path, n.children, n.model is None) for n in tree.nodes] == [
        ((), ["money", "sport"], False), (("money",), ["stocks"], True), (("sport",), ["football", "tennis"], False),
    ]
    items = [(1, "a late goal"), (2, "ace on court"), (3, "股票上涨"), (4, "the shares"), (5, None), (6, "")]
    docs = spark.createDataFrame(items, "item_id long, text string")
    got = classify.classify_tree(docs, tree, ["item_id"])
    weight = {(r.item_id, r.path, r.tag): r.weight for r in got.collect()}
    assert len(weight) == 6 * 5
    for i, _ in items:
        assert weight[i, "", "money"] == pytest.approx(weight[i, "money", "stocks"])
        assert weight[i, "", "sport"] == pytest.approx(weight[i, "sport", "football"] + weight[i, "sport", "tennis"])
        assert weight[i, "", "sport"] + weight[i, "", "money"] == pytest.approx(1.0)
    best = {r.item_id: (r.path, r.tag) for r in classify.best_path(got, tree, ["item_id"]).collect()}
    assert {i: best[i] for i in (1, 2, 3, 4)} == {1: ("sport", "football"), 2: ("sport", "tennis"), 3: ("money", "stocks"), 4: ("money", "stocks")}
    assert classify.classify_tree(docs, tree, ["item_id"], 0.6).where(F.col("weight") < 0.6).count() == 0
    assert classify.classify_tree(docs.limit(0), tree, ["item_id"]).count() == 0
    with pytest.raises(ValueError):
        classify.fit_tree(labelled.limit(0), ["top"])


def test_tokens(spark):
    rows = spark.createDataFrame([("Ab c-d 9", 1), ("今天好 x", 2), (None, 3), ("ไทย", 4)], "text string, k int")
    got = {r.k: sorted(r.t) for r in rows.select("k", classify.tokens("text").alias("t")).collect()}
    assert got[1] == ["9", "ab", "c", "d"] and {"今天", "天好", "x"} <= set(got[2]) and got[3] == [] and "ไท" in got[4]


def test_letters_of_words(spark):
    texts = ["Ab cde-fghi 9", "𝒳𝒴𝒵𝒳 ab", "", "éàü12 · x", "今天好 abc"]
    rows = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "text string, k int")
    got = {r.k: [t for t in r.t if t.startswith("~")] for r in rows.select("k", classify.tokens("text", 3).alias("t")).collect()}
    assert got == {0: ["~cde", "~fgh", "~ghi"], 1: ["~𝒳𝒴𝒵", "~𝒴𝒵𝒳"], 2: [], 3: ["~éàü", "~àü1", "~ü12"], 4: ["~今天好", "~abc"]}


def test_labelled_texts_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    labelled = spark.createDataFrame(ROWS, "text string, top string, sub string").withColumn("text", counted("text"))
    classify.fit_tree(labelled, ["top", "sub"], features=1 << 10)
    assert read.value == len(ROWS)

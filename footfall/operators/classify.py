"""Hierarchical text classification: a classifier per inner node of the category tree.

A text is words, and pairs of characters where the script has no spaces. Feature vectors are made once; each parent category has
a model that tells its children apart, fitted on the rows below it. Scoring goes top down in one pass over the items: the
weight of a category is its parent's weight times its share there, so children add up to their parent and leaves to 1.

The tree comes from the labelled rows. Its size is that of the category table; the driver fits one node after the other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from footfall.session import materialize

UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"

TASKS_PER_CORE = 4


def _tasks(rows: DataFrame) -> int:
    return TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism


def tokens(text: Column | str, letters: int = 0) -> Column:
    """Lower-case words, and neighbouring characters of scripts written without spaces; with ``letters`` also the runs of so
    many characters inside words, which tell languages apart by few texts."""
    lower = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    words = F.array_remove(F.split(lower, r"[^\p{L}\p{M}\p{N}]+"), "")
    runs = F.regexp_extract_all(lower, F.lit(rf"{UNSPACED}{{2,}}"), F.lit(0))
    pairs = F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.char_length(r) - 1), lambda i: F.substring(r, i, F.lit(2))))
    # All these scripts lie above U+0E00; other texts are spared the search.
    far = lower.rlike(r"[\x{0E00}-\x{10FFFF}]")
    parts = [words, F.when(far, F.flatten(pairs)).otherwise(F.array().cast("array<string>"))]
    if letters:
        # A lookahead matches at every letter, so one pass finds overlapping runs.
        runs = F.regexp_extract_all(lower, F.lit(rf"(?=([\p{{L}}\p{{M}}\p{{N}}]{{{letters}}}))"), F.lit(1))
        parts.append(F.transform(runs, lambda r: F.concat(F.lit("~"), r)))
    return F.concat(*parts)


@dataclass
class Node:
    """Children of one parent category; without a model there is a single child."""

    path: tuple[str, ...]
    children: list[str]
    model: object | None


@dataclass
class Tree:
    levels: list[str]
    features: object
    letters: int = 0
    nodes: list[Node] = field(default_factory=list)  # parents before children


def fit_tree(
    labelled: DataFrame, levels: Sequence[str], features: int = 1 << 14, iterations: int = 20, regularization: float = 0.01, letters: int = 0
) -> Tree:
    """Fit on rows of ``text`` and one category column per level, top level first. Rows without a category at some level
    teach the nodes above it only; of an empty tree nothing can be scored, so no labelled row at all is an error."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, IDF, StringIndexer

    levels = list(levels)
    counts = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features)
    # Cutting words and letters costs most: the texts are dealt to all cores, however few files they come from, and read once.
    rows = labelled.repartition(_tasks(labelled))
    rows = counts.transform(rows.select(tokens("text", letters).alias("_words"), *levels)).select("_tf", *levels)
    rows = materialize(rows, "classifier-rows")
    if rows.isEmpty():
        raise ValueError("no labelled rows")
    idf = IDF(inputCol="_tf", outputCol="_features").fit(rows)
    rows = idf.transform(rows).select("_features", *levels)
    tree = Tree(levels, PipelineModel([counts, idf]), letters)
    parents: list[tuple[str, ...]] = [()]
    for depth, level in enumerate(levels):
        known = [F.col(c).isNotNull() for c in levels[: depth + 1]]
        here = rows.where(known[0] if depth == 0 else F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in levels[: depth + 1])))
        names: dict[tuple[str, ...], list[str]] = {}
        for *path, child in sorted(tuple(r) for r in here.select(*levels[: depth + 1]).distinct().collect()):
            names.setdefault(tuple(path), []).append(child)
        following = []
        for path in (p for p in parents if p in names):
            below = here
            for column, value in zip(levels, path, strict=False):
                below = below.where(F.col(column) == value)
            model = None
            if len(names[path]) > 1:
                indexer = StringIndexer(inputCol=level, outputCol="_label", stringOrderType="alphabetAsc").fit(below)
                names[path] = list(indexer.labels)
                lr = LogisticRegression(featuresCol="_features", labelCol="_label", maxIter=iterations, regParam=regularization)
                model = lr.fit(indexer.transform(below).select("_features", "_label"))
            tree.nodes.append(Node(path, names[path], model))
            following += [(*path, child) for child in names[path]]
        parents = following
    return tree


def classify_tree(items: DataFrame, tree: Tree, id_columns: Sequence[str], min_weight: float = 0.0) -> DataFrame:
    """(id columns, level, path, tag, weight) of every category; ``path`` names its parents, '/'-joined."""
    from pyspark.ml.functions import vector_to_array

    items = items.select(*id_columns, "text").repartition(_tasks(items), *id_columns)
    scored = tree.features.transform(items.select(*id_columns, tokens("text", tree.letters).alias("_words"))).select(*id_columns, "_features")
    for k, node in enumerate(tree.nodes):
        if node.model is None:
            scored = scored.withColumn(f"_p{k}", F.array(F.lit(1.0)))
            continue
        model = node.model.copy().setProbabilityCol(f"_v{k}").setRawPredictionCol("").setPredictionCol("")
        scored = model.transform(scored).withColumn(f"_p{k}", vector_to_array(f"_v{k}")).drop(f"_v{k}")
    weight: dict[tuple[str, ...], Column] = {(): F.lit(1.0)}
    entries = []
    for k, node in enumerate(tree.nodes):
        for i, child in enumerate(node.children):
            path = (*node.path, child)
            weight[path] = weight[node.path] * F.get(f"_p{k}", F.lit(i))
            entries.append(
                F.struct(
                    F.lit(len(node.path)).alias("level"), F.lit("/".join(node.path)).alias("path"), F.lit(child).alias("tag"), weight[path].alias("weight")
                )
            )
    return scored.select(*id_columns, F.inline(F.array(*entries))).where(F.col("weight") >= min_weight)


def best_path(classified: DataFrame, tree: Tree, id_columns: Sequence[str]) -> DataFrame:
    """The heaviest leaf of every item: (id columns, path, tag, weight). Equal weights go by path and tag."""
    inner = ["/".join(node.path) for node in tree.nodes if node.path]
    full = F.concat_ws("/", F.when(F.col("path") != "", F.col("path")), "tag")
    leaves = classified.where(~full.isin(*inner)) if inner else classified
    order = F.struct((-F.col("weight")).alias("w"), "path", "tag")
    return leaves.groupBy(*id_columns).agg(F.min_by(F.struct("path", "tag", "weight"), order).alias("_b")).select(*id_columns, "_b.*")

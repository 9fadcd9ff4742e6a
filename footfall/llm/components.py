"""Connected components of an edge table, by contracting towards the smaller neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.session import materialize, scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node reachable.

    In each round a node takes its smallest neighbour's choice, edges move to the chosen nodes, and edges inside one node
    vanish. At least half of the nodes that still have edges go per round. Every round is written to the shared folder.
    """
    spark, roots = edges.sparkSession, None
    with scratch(spark) as keep:
        edges = materialize(_tidy(edges), "edges")
        while not edges.isEmpty():
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            chosen = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
            chosen = chosen.select("node", F.least("node", "_m").alias("root"))
            onward = chosen.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            chosen = materialize(chosen.join(onward, "root").select("node", F.col("_next").alias("root")), "roots")
            moved = edges.join(chosen.select(F.col("node").alias("a"), F.col("root").alias("_a")), "a")
            moved = moved.join(chosen.select(F.col("node").alias("b"), F.col("root").alias("_b")), "b")
            edges = materialize(_tidy(moved.select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "edges")
            if roots is None:
                roots = chosen
            else:
                step = chosen.select(F.col("node").alias("root"), F.col("root").alias("_next"))
                roots = materialize(roots.join(step, "root", "left").select("node", F.coalesce("_next", "root").alias("root")), "roots")
        if roots is None:
            roots = materialize(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), "roots")
        return keep(roots)


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(F.col("a") < F.col("b")).distinct()

"""Connected components of links between numbers, without a hub's links meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node reachable over links (a, b) of bigint nodes; nodes without a link are left out.

    Every round hangs each node below the smallest label among its neighbours, then
    links are rewritten between labels, and those within one label go. Labels are
    summed up by partial minima, so a node with very many links costs each task one
    row. The forest of labels is followed to its roots at the end, by doubling.
    """
    edges = written(links.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "edges")
    parents = None
    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("parent")), "hung")
        hung = _roots(hung)
        parents = hung if parents is None else written(
            parents.join(hung.select(F.col("node").alias("parent"), F.col("parent").alias("up")), "parent", "left")
            .select("node", F.coalesce("up", "parent").alias("parent")).unionByName(hung).groupBy("node").agg(F.min("parent").alias("parent")),
            "parents",
        )
        first = hung.select(F.col("node").alias("a"), F.col("parent").alias("p"))
        second = hung.select(F.col("node").alias("b"), F.col("parent").alias("q"))
        moved = edges.join(first, "a").join(second, "b").where("p <> q")
        edges = written(moved.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "edges")
    else:
        raise RuntimeError(f"links still merge after {max_rounds} rounds")
    if parents is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return parents.select("node", F.col("parent").alias("label"))


def _roots(forest: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, parent) with each parent replaced by the root above it; a parent is never larger than its node."""
    for _ in range(max_rounds):
        up = forest.where("node <> parent").select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        moved = forest.join(up, "parent", "left").select("node", F.coalesce("up", "parent").alias("next"), (F.col("up").isNotNull()).alias("moved"))
        moved = written(moved, "roots")
        forest = moved.select("node", F.col("next").alias("parent"))
        if moved.where("moved").isEmpty():
            return forest
    raise RuntimeError(f"labels still move after {max_rounds} rounds")

"""Groups of companies linked by shared keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .skew import hot_join


def usable_links(nodes: DataFrame, node: str, key: str, max_size: int) -> DataFrame:
    """(node, link) rows of the keys shared by 2 to `max_size` nodes."""
    pairs = nodes.select(F.col(node).alias("node"), F.col(key).cast("string").alias("link")).filter(
        "node is not null and link is not null"
    )
    sizes = pairs.groupBy("link").agg(F.count("*").alias("n")).filter(F.col("n").between(2, max_size))
    return pairs.join(sizes.select("link"), "link", "left_semi").withColumn(
        "link", F.concat(F.lit(f"{key}:"), F.col("link"))
    )


def linked_groups(nodes: DataFrame, node: str, limits: dict[str, int], max_rounds: int = 60) -> DataFrame:
    """(node, group_id): smallest node id among all nodes reachable by shared keys.

    Keys above their size limit link nothing. Labels spread over links, whose
    size the limits bound, and then jump along labels, so the number of rounds
    grows with the logarithm of the longest chain rather than its length. Each
    round is checkpointed.
    """
    links = None
    for key, size in limits.items():
        part = usable_links(nodes, node, key, size)
        links = part if links is None else links.unionByName(part)
    links = cut_lineage(links)
    labels = links.select("node").distinct().withColumn("label", F.col("node"))
    for _ in range(max_rounds):
        link_label = links.join(labels, "node").groupBy("link").agg(F.min("label").alias("label"))
        spread = links.join(link_label, "link").groupBy("node").agg(F.min("label").alias("near"))
        near = labels.join(spread, "node").withColumn("near", F.least("near", "label"))
        # A label names a node; take over the label that node has reached.
        targets = near.select(F.col("node").alias("near"), F.col("near").alias("far"))
        # The labels of the last round are counted: they show which ones are hot.
        counted = labels.select(F.col("label").alias("near"))
        jumped = hot_join(near, targets, ["near"], "inner", counted=counted, unique=True)
        moved = jumped.select("node", "label", F.least("near", "far").alias("next"))
        moved = cut_lineage(moved)
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.filter(F.col("label") != F.col("next")).isEmpty():
            break
    else:
        raise RuntimeError(f"labels still move after {max_rounds} rounds")
    everyone = nodes.select(F.col(node).alias("node")).distinct()
    return everyone.join(labels, "node", "left").select(
        F.col("node").alias(node), F.coalesce("label", "node").alias("group_id")
    )

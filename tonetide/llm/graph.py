"""Connected components as repeated contraction of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.llm.common import keep


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every end of a link.

    Each round hooks every node to its smallest neighbour, follows those pointers
    to their roots, and rewrites the links between roots. Every root with a link
    left disappears into another, so the rounds grow with the logarithm of the
    longest path. A hub is one row of pointers and its links meet only in a
    minimum, which combines before the shuffle.
    """
    edges = keep(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where("a < b")
        .distinct(),
        "links",
    )
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            edges.select("b", "a")
        )
        roots = keep(
            ends.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "roots"
        )
        while True:
            up = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
            step = keep(
                roots.join(up, "root").select(
                    "node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")
                ),
                "roots",
            )
            moved = not step.where("moved").isEmpty()
            roots = step.drop("moved")
            if not moved:
                break
        if labels is None:
            labels = roots.withColumnRenamed("root", "component")
        else:
            over = roots.select(F.col("node").alias("component"), "root")
            labels = keep(
                labels.join(over, "component", "left").select(
                    labels["node"], F.coalesce("root", "component").alias("component")
                ),
                "labels",
            )
        for end in ("a", "b"):
            edges = edges.join(roots.withColumnRenamed("node", end), end).drop(end)
            edges = edges.withColumnRenamed("root", end)
        edges = keep(edges.select("a", "b").where("a <> b").distinct(), "links")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.withColumnRenamed("node", "id")

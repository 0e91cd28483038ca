"""Connected components of a table of edges, by contraction to least neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.sources.staging import stage


def _jump(parents: DataFrame) -> DataFrame:
    """Follow parents to the roots; each round doubles the distance covered."""
    while True:
        up = parents.select(F.col("node").alias("via"), F.col("label").alias("up"))
        jumped = stage(
            parents.join(up, parents["label"] == up["via"]).select(
                "node", F.col("up").alias("label"), (F.col("up") != F.col("label")).alias("moved")
            ),
            "jump",
        )
        parents = jumped.select("node", "label")
        if not jumped.filter("moved").head(1):
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for each node with an edge; the label is the least node it reaches.

    ``edges`` has two bigint columns.  In each round nodes point to their least
    neighbour, trees of pointers are flattened, and edges between different
    trees become the edges of the next round, so that the graph shrinks by at
    least half of its nodes.  All tables stay distributed; minima are combined
    before they shuffle.
    """
    a, b = edges.columns
    edges = stage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct(), "edges")
    levels = []
    while edges.head(1):
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stage(
            ends.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")),
            "parents",
        )
        parents = _jump(parents)
        levels.append(parents)
        of_a = parents.select(F.col("node").alias("a"), F.col("label").alias("to_a"))
        of_b = parents.select(F.col("node").alias("b"), F.col("label").alias("to_b"))
        edges = stage(
            edges.join(of_a, "a")
            .join(of_b, "b")
            .filter("to_a <> to_b")
            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
            .distinct(),
            "contracted",
        )
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = levels.pop()
    while levels:
        lower = levels.pop().select("node", F.col("label").alias("via"))
        top = labels.select(F.col("node").alias("via"), F.col("label").alias("top"))
        labels = stage(
            lower.join(top, "via", "left").select(
                "node", F.coalesce("top", "via").alias("label")
            ),
            "labels",
        )
    return labels

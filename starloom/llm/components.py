"""Connected components by contraction: links in, least member of each component out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` of every node in ``links`` (columns ``a`` and ``b``).

    Each round every node takes the least of itself and its neighbours as parent,
    then its parent's parent. Links between different parents go on to the next
    round, so the graph shrinks to nothing in a number of rounds that grows with
    the logarithm of its longest path. The least node of a component never moves.
    """
    edges = stage(links.where("a <> b").select("a", "b").distinct(), "links")
    labels = stage(
        edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node")),
        "labels",
    )
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), "parents")
        above = parents.toDF("p", "pp")
        jumped = stage(parents.join(above, "p", "left").select("a", F.coalesce("pp", "p").alias("p")), "jumped")
        labels = stage(
            labels.join(jumped.toDF("label", "p"), "label", "left").select("node", F.coalesce("p", "label").alias("label")),
            "labels",
        )
        edges = stage(
            edges.join(jumped.toDF("a", "pa"), "a")
            .join(jumped.toDF("b", "pb"), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "links",
        )
    return labels

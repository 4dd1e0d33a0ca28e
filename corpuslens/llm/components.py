"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (least node reachable) of every node of ``edges(a, b)``.

    Every round points each node to the least of its neighbours, follows two such pointers at
    once and contracts the graph to the nodes pointed to. Equal edges melt together, so the
    graph shrinks quickly; a star vanishes in one round. All tables stay distributed; the
    driver only learns whether edges are left.
    """
    rounds = []
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct())
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("to"))
        near = materialize(near.select(F.col("a").alias("node"), F.least("a", "to").alias("to")))
        step = near.select(F.col("node").alias("to"), F.col("to").alias("next"))
        far = materialize(near.join(step, "to").select("node", F.col("next").alias("to")))
        rounds.append(far)
        ends = far.select(F.col("node").alias("a"), F.col("to").alias("_a"))
        others = far.select(F.col("node").alias("b"), F.col("to").alias("_b"))
        edges = edges.join(ends, "a").join(others, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = materialize(edges.filter("a <> b").distinct())
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        later = labels.select(F.col("node").alias("to"), F.col("to").alias("_last"))
        labels = earlier.join(later, "to", "left").select("node", F.coalesce("_last", "to").alias("to"))
    return labels.withColumnRenamed("to", "component")

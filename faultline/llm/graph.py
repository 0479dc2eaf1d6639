"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.session import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge to another.

    Each round hooks every label onto its smallest neighbour, follows the chains that makes to their ends, and moves
    the edges onto the surviving labels, which at least halves the labels of every component that is not done. Sums are
    minima, so a node with a third of all edges is combined before the shuffle, and its rows in the joins are split by
    AQE. Rounds are written tables; only their row counts reach the driver. Loops, repeated edges, edges with a NULL
    end and an empty table are allowed; the first three add nothing.
    """
    kind = edges.schema[a].dataType.simpleString()
    links = edges.select(F.col(f"`{a}`").alias("x"), F.col(f"`{b}`").alias("y")).filter("x <> y")
    links = written(links.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "links")
    labels = edges.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    first = True
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        parent = written(both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("up")), "parents")
        while True:
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            step = written(parent.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "jump")
            parent = step.drop("moved")
            if step.filter("moved").isEmpty():
                break
        if first:
            labels, first = parent.select("node", F.col("up").alias("component")), False
        else:
            merged = labels.join(parent.select(F.col("node").alias("component"), "up"), "component", "left")
            labels = written(merged.select("node", F.coalesce("up", "component").alias("component")), "labels")
        at_x = parent.select(F.col("node").alias("x"), F.col("up").alias("to_x"))
        at_y = parent.select(F.col("node").alias("y"), F.col("up").alias("to_y"))
        moved = links.join(at_x, "x").join(at_y, "y").filter("to_x <> to_y")
        links = written(moved.select(F.least("to_x", "to_y").alias("x"), F.greatest("to_x", "to_y").alias("y")).distinct(), "links")
    return labels

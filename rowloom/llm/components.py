"""Connected components of links between nodes, as Spark joins.

A distributed union-find: every node hooks on to the least node it knows (large and small stars in turn,
which is union and path compression at once) until nothing changes. Each round is two aggregations and joins over
the links, written to the shared folder; the number of rounds grows with the logarithm of the longest
chain. Hot nodes are only ever aggregated or joined, never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.sources.shared import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: neighbours above a node hook on to its least neighbour; small star: those below, and the node."""
    sides = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        sides = sides.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = sides.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        moved = sides.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        # links point from the greater node a to the lesser b
        least = sides.groupBy("u").agg(F.min("v").alias("m"))
        moved = sides.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a != b")
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in links (a, b), root being the least node of the component.

    NULL ends and links of a node to itself say nothing and are left out; no links give no rows.
    """
    links = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "links")
    before = None
    while True:
        links = materialize(_star(_star(links, large=True), large=False), "links")
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    roots = links.select("b").distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))

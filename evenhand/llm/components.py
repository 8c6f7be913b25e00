"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.llm.tables import saved


def _lowest(links: DataFrame) -> DataFrame:
    """For each node the smallest among itself and its neighbours."""
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("to"))
    )
    return ends.groupBy("id").agg(F.least(F.min("to"), F.col("id")).alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id) of every id in ``edges`` (a, b).

    Large-star and small-star steps in turn until nothing changes: each links neighbours to the
    smallest node next to them, so the number of links never grows and paths halve. No step gathers
    the neighbours of a node; they are reduced to a minimum, which is joined back.
    """
    links = saved(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    seen = None
    while True:
        low = _lowest(links)
        # each neighbour above a node is linked to the node's lowest
        ends = links.select(F.col("a").alias("id"), F.col("b").alias("to"))
        large = ends.join(low, "id").select(F.col("low").alias("a"), F.col("to").alias("b"))
        # and each node, with the neighbours below it, to the lowest of these
        step = large.filter("a <> b").distinct()
        least = step.groupBy("b").agg(F.min("a").alias("low"))
        down = step.join(least, "b")
        small = down.select(F.col("low").alias("a"), F.col("a").alias("b")).unionByName(
            down.select(F.col("low").alias("a"), "b")
        )
        links = saved(small.filter("a <> b").distinct(), "small-star")
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == seen:
            break
        seen = state
    tree = links.select(F.col("b").alias("id"), F.col("a").alias("component"))
    roots = links.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return saved(tree.unionByName(roots), "components")

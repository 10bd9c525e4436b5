"""Connected components by contraction, all in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonlake.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); a component is named by its least node.

    A round points each node at its least neighbour or itself, shortens the pointers, renames both ends of
    every link and drops links inside one name. Links shrink with each round until none is left. Minima have
    partial sums and joins meet true sizes, so a node with a great many links is no hot spot.
    Links with a null end and links of a node to itself are left out. No links: no rows.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = staged(links.where("a is not null and b is not null and a <> b").select(low.alias("a"), high.alias("b")).distinct(), "links")
    named = None
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).withColumn("to", F.least("node", "to")), "points")
        for _ in range(2):
            onward = points.select(F.col("node").alias("to"), F.col("to").alias("next"))
            points = staged(points.join(onward, "to").select("node", F.col("next").alias("to")), "points")
        ends = lambda c, to: points.select(F.col("node").alias(c), F.col("to").alias(to))  # noqa: E731, B023
        renamed = links.join(ends("a", "x"), "a").join(ends("b", "y"), "b").where("x <> y")
        links = staged(renamed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if named is None:
            named = points.select("node", F.col("to").alias("component"))
        else:
            step = ends("component", "next")
            named = staged(named.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component")), "named")
    return named if named is not None else links.select(F.col("a").alias("node"), F.col("b").alias("component"))

"""Connected components of a graph of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from olapkit.workspace import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; the root is the least node of its component.

    Alternates the two star operations: each node hands its larger neighbours to
    its least neighbour, then its smaller ones. Every round is written to the
    shared folder; the number of rounds grows with the logarithm of the longest
    chain. A hub is handled by partial aggregates and by joins that Spark can split.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges, before = materialize(edges, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Larger neighbours of each node go to the least of its neighbourhood.
        large = materialize(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large-star",
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = materialize(small.where("u != v").distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        before = state

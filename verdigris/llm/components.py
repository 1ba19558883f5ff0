"""Connected components of a table of links, by alternating stars; only labels travel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.sources.storage import stored


def _print(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes: two rounds with the same one changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("high", "low").cast("long"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it can reach.

    Each round every node points the larger of its neighbours, then the smaller ones, at the smallest
    (Kiveris et al. 2014); rounds grow with the logarithm of a component's size. Each is written to
    shared storage. Minima combine before the shuffle and joins are split by adaptive execution, so a
    node with very many links is not one task. Loops and repeated links do no harm.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).filter("high > low").distinct(), "links"
    )
    before = _print(edges)
    while True:
        both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
        # Larger neighbours go to the smallest neighbour.
        large = both.filter("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))
        large = stored(large.filter("high > low").distinct(), "links")
        # Smaller neighbours, and the node itself, go to the smallest of them.
        lowest = large.groupBy("high").agg(F.min("low").alias("least"))
        joined = large.join(lowest, "high")
        small = joined.select(F.col("low").alias("high"), F.col("least").alias("low")).filter("high > low").unionByName(
            lowest.select("high", F.col("least").alias("low"))
        )
        edges = stored(small.distinct(), "links")
        now = _print(edges)
        if now == before:
            break
        before = now
    labelled = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return labelled.unionByName(roots)

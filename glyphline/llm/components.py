"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from glyphline.session import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of an edge in ``a, b``.

    Rounds of two steps over edges that point from a node to a smaller one. *Large star*
    links every larger neighbour of a node to the least node of its neighbourhood; *small
    star* does so for the smaller neighbours. Both keep the components and shorten paths,
    so a logarithmic number of rounds leaves stars. The least neighbour is an aggregate with
    map-side combine, joined back, so a node with very many links is no single group; every
    round is checkpointed.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    links = checkpointed(links)
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = _star(both, larger=True)
        links = checkpointed(_star(links, larger=False))
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if state == before:
            break
        before = state
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours of each u (those above it, or all, which are below it) to its least neighbour or itself."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "centre")
    joined = links.join(least, F.col("u") == F.col("centre"))
    if larger:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("centre").alias("u"), F.col("m").alias("v"))
        )
    return moved.filter("u <> v").distinct()

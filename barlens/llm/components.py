"""Connected components of a link table, by alternating large-star and
small-star rounds (O(log**2 n) rounds, each two shuffles of the links)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.sinks import materialize


def _state(edges: DataFrame) -> tuple:
    """(number, order-free checksum) of the edges."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them.
    All edges point from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two columns, any orderable
    type); component is the least node of it. Self links and nulls don't link.
    A hub with very many links is met by partial aggregation and by joins that
    adaptive execution can split; nothing is gathered per node.
    """
    a, b = links.columns
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    edges = materialize(edges, "cc")
    state = _state(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "cc")
        new = _state(edges)
        if new == state:
            break
        state = new
    # every node now points to the least node of its component
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)

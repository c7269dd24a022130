"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.session import cut_lineage, joinable


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; a component is named by its least node.

    Each step hangs the neighbours of a node on the least of them (Kiveris et al.,
    "Connected Components in MapReduce and Beyond", 2014): the number of rounds is
    logarithmic in practice and the edge table never grows. The least neighbour is
    an aggregate that combines on the map side; it is staged before it is joined, since only then can
    adaptive execution split the rows of a hub.
    """
    current = cut_lineage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u != v")
        .distinct()
    )
    before = _fingerprint(current)
    while True:
        current = cut_lineage(_small_star(cut_lineage(_large_star(current))))
        after = _fingerprint(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = joinable(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = joinable(edges.groupBy("u").agg(F.min("v").alias("m")))
    rehung = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rehung.union(least.select("u", F.col("m").alias("v"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())

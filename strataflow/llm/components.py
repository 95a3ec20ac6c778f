"""Connected components of a graph given as edges, by joins; nothing of the graph reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.session import stage


def _neighbours_to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link every neighbour of a node (the larger ones only, or the smaller ones) to the least of the node's neighbourhood.

    The least is brought to the edges by a join, not by gathering a node's neighbours, so that a node with very many
    of them is no single group; Spark splits its rows.
    """
    both = edges if not larger_only else edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if larger_only:
        return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Node and least node of its component, as (id, component_id), for every node that `edges` (a, b) names.

    Alternates the large-star and small-star steps, which need a number of rounds that grows with the logarithm of the
    graph's diameter; each round is written to the shared folder. Null ends, loops and repeated edges count for
    nothing. Nodes without an edge are not returned; no edges give no rows.
    """
    ordered = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    ordered = ordered.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current, before = stage(ordered, label), None
    if current.isEmpty():
        return current.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    while True:
        # each node's larger neighbours to its least neighbour, then each node's smaller neighbours to theirs
        large = _neighbours_to_least(current, larger_only=True).filter("u <> v").distinct()
        small = _neighbours_to_least(large, larger_only=False)
        turned = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        current = stage(turned.filter("u <> v").distinct(), label)
        now = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    stars = current.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return stars.union(current.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())

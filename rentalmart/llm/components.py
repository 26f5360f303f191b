"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, stored
from .hot_groups import join_groups


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id and component (the least id reachable) for every id in ``links``.

    Null ends and self-links are passed over. Every step groups by a node after partial
    aggregation, so a hub is one row per task in the grouping, and joins the least neighbour
    back; the links of hubs stay where they are for that (``join_groups``).
    """
    edges = stored(links.where(F.col(a) != F.col(b))
                   .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("size")), "least")
        large = (join_groups(both.where("v > u"), least, ["u"], "size", 2 * state[0])
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(large, "large_star")
        drop(least)
        least = stored(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size")), "least")
        small = (join_groups(large, least, ["u"], "size", large.count()).where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        small = stored(small, "small_star")
        new = _state(small)
        drop(edges)
        drop(large)
        drop(least)
        edges = small
        if new == state:
            break
        state = new
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))

"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import materialise


def _turn(edges: DataFrame, low: DataFrame) -> DataFrame:
    """Edges (u, v) with the smallest neighbour of u; ``low`` is a written
    table, so both join sides are plain exchanges that Spark can split when
    one node has very many links."""
    return edges.join(low, "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = materialise(both.groupBy("u").agg(F.min("v").alias("low")), "large_star_low")
    turned = _turn(both.where("v > u"), low)
    return turned.select(F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = materialise(edges.groupBy("u").agg(F.min("v").alias("low")), "small_star_low")
    turned = _turn(edges, low).where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return turned.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """The component of every node in ``links`` (longs ``u``, ``v``) as
    (node, component): the component is the smallest node that links reach.

    Self-links, repeated links and either direction are allowed; no links
    give an empty table. Each round is written to the shared checkpoint
    folder, which cuts the lineage; links never reach the driver. The rounds
    grow with the logarithm of the longest chain.
    """
    edges = materialise(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links")
    state = lambda df: df.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = state(edges)
    while before[0]:
        edges = materialise(small_star(materialise(large_star(edges), "large_star")), "small_star")
        after = state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())

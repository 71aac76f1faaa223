"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import drop, settled, tidied


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(neighbours: DataFrame, only_larger: bool) -> DataFrame:
    """Links every neighbour of a node (and, in the small star, the node) to the least of them all."""
    least = neighbours.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = neighbours.join(least, "u")
    out = met.filter("v > u") if only_larger else met.filter("v <> m").unionByName(
        least.filter("u <> m").withColumn("v", F.col("u")).select("u", "v", "m"))
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node has two ways to smaller ones, or lies between two others: then the edges are no stars yet."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    with tidied(edges.sparkSession):
        return nodes.agg(F.coalesce(F.bool_or((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)), F.lit(False))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """``id, component``: the smallest node reachable, for every node of ``edges`` (``u, v``).

    Each round writes its edges to the shared folder, so nothing is recomputed after a loss, and
    removes those of the round before; the
    number of rounds grows with the logarithm of a component's size. A node with very many
    neighbours is spread by the joins, whose minima are combined before the shuffle.
    """
    current = settled(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    while _unfinished(current):
        large = _star(_both_ways(current), only_larger=True)
        following = settled(_star(large.filter("v < u"), only_larger=False), "components")
        drop(current)
        current = following
    nodes = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    labels = settled(nodes.unionByName(roots), "component-labels")
    drop(current)
    return labels


def extended(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``components`` of the edges that gave ``labels`` and of further ones; drops the old labels.

    A component goes in as its star, so rounds are spent on what the new edges join alone.
    """
    stars = labels.select(F.col("id").alias("u"), F.col("component").alias("v"))
    found = components(stars.unionByName(edges))
    drop(labels)
    return found

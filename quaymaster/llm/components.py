"""Connected components of a graph given by its links, as Spark joins.

Alternating large and small stars: every round links each node's larger neighbours, and then its
smaller ones, to the least node it knows; the links end as stars around the least node of
each component. The least neighbour is an aggregate that combines before the shuffle, and a node
with very many links meets it in a join that adaptive execution can split. Rounds are written,
so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quaymaster.session import materialise


def _least(links: DataFrame) -> DataFrame:
    """(u, v) with the least neighbour or own number ``m`` of u."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return links.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _least(down)
    out = found.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); a component has the number of its least node.

    Nodes without links do not appear. Links may repeat and be given in either direction; loops are left out.
    """
    now = links.select(F.col("u").cast("bigint"), F.col("v").cast("bigint")).where("u <> v").distinct()
    seen = None
    while True:
        now = materialise(_small_star(_large_star(now)), "stars")
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("bigint"))).first())
        if state == seen:
            break
        seen = state
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.scratch import materialise


def _minima(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge with the smallest of u and its neighbours; minima are combined before the shuffle."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to its smallest one."""
    rows = _minima(_both(edges)).where(F.col("v") > F.col("u"))
    return rows.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    rows = _minima(down)
    moved = rows.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (u, v).

    Self-links, repeated links and either direction are accepted; nulls are not
    links. Every round is written to the shared folder, so a lost executor costs
    one round at most. It ends when the links no longer change.
    """
    wanted = F.col("u").isNotNull() & F.col("v").isNotNull()
    given = materialise(edges.select("u", "v").where(wanted), "component-links")
    links, before = given.where(F.col("u") != F.col("v")).distinct(), None
    while True:
        links = materialise(_small_star(_large_star(links)), "component-round")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    alone = given.select(F.explode(F.array("u", "v")).alias("u")).distinct()
    found = alone.join(links, "u", "left")
    return found.select(F.col("u").alias("node"), F.coalesce("v", "u").alias("component"))

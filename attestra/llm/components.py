"""Connected components of links by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import stored


def _star(edges: DataFrame) -> DataFrame:
    """(u, v) with the least neighbour of u, itself included, as m. The minimum is pre-aggregated; a hot u is split in the join."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node of its component) for all nodes of edges (a, b). Nulls and loops are passed over; no edges give no rows.

    Every round is a written table; the number of rounds is logarithmic in the size of the largest component.
    """
    links = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = stored(large, "links")  # every u is above its v
        small = _star(large)
        links = stored(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links")
        # both steps keep what is connected; once every node has one link and no link leads on, each leads to its component's least node
        if links.groupBy("u").count().filter("count > 1").isEmpty() and links.join(links.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links (a, b): only links between components go through the rounds, by the components' names."""
    side = lambda c: comps.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))
    between = links.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).filter("a <> b").distinct()
    between = stored(between, "between")
    if between.isEmpty():
        return comps
    up = stored(components(between), "up")
    old = comps.join(up.select(F.col("node").alias("component"), F.col("component").alias("_up")), "component", "left").select("node", F.coalesce("_up", "component").alias("component"))
    return stored(old.unionByName(up.join(comps.select("node"), "node", "left_anti")), "components")

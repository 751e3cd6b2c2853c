"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidelane.llm.common import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node that has a link.

    Links are unordered, may repeat, may be null (ignored) and may join a node to itself.
    Each round replaces the links by stars around smaller nodes, until nothing changes; the
    number of rounds grows with the logarithm of a component's width. Neighbour lists are never
    gathered: a star is the first of a node's links in order, handed down them, and links that repeat are dropped on the way.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u is not null and v is not null and u != v"), "links")
    of_node = Window.partitionBy("u").orderBy("v")
    stars = {"m": F.first("v").over(of_node), "before": F.lag("v").over(of_node)}
    mark = _mark(edges)
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumns(stars).filter("v > u and (before is null or before != v)")
        large = large.select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        small = large.withColumns(stars).filter("before is null or before != v")
        edges = stored(small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    # Now every node but the smallest of a component has one link, to the smallest.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))


def _mark(edges: DataFrame) -> tuple:
    """Number and sum of hashes; a sum, as links may repeat on the way."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

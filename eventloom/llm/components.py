"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables

#: Links that one task takes.
LINKS_A_TASK = 250_000


def _tasks(rows: int) -> int:
    return 4 + rows // LINKS_A_TASK


def _state(edges: DataFrame) -> tuple[int, bool]:
    """(links, are all parts stars?): does every node have one way down, to a node with none?"""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("id").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    n, most, mixed = nodes.agg(F.sum("down"), F.max("down"), F.max(F.least("down", "up"))).first()
    return n or 0, (most or 0) <= 1 and not mixed


def components(links: DataFrame, a: str = "a", b: str = "b", tables: Tables | None = None) -> DataFrame:
    """(id, component): for each id in a link, the smallest id reachable.  Links are undirected; repeats do no harm.

    Each round links every node to the smallest id seen among its neighbours and
    itself, first towards larger nodes, then towards smaller ones, so paths shorten
    by half or more; it ends when every part is a star around its smallest node.  Both steps sum
    over a node with map-side combining, and a node of very many links is split by the join.
    The rounds' tables lie in the shared folder, each deleted when the next is written; only counts
    come to the driver.
    """
    tables = tables or Tables(links.sparkSession)
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = tables.write(edges, "links")
    rows, done = _state(edges)
    while not done:
        # large star: every larger neighbour of u, and u, points to the least of u's neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u and m < v").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = tables.write(large, "links", _tasks(rows))
        # small star: u and its smaller neighbours point to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
        old, edges = edges, tables.write(small.where("u <> v").distinct(), "links", _tasks(rows))
        tables.drop(old, large)
        rows, done = _state(edges)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def joined_parts(parts: DataFrame, links: DataFrame, tables: Tables, tasks: int | None = None) -> DataFrame:
    """Components (id, component) after more links (a, b): only the components that these touch are worked on."""
    label = lambda end: parts.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
    ends = links.join(label("a"), "a", "left").join(label("b"), "b", "left")
    moved = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), tables=tables)
    new = moved.select(F.col("id").alias("component"), F.col("component").alias("now"))
    old = parts.join(new, "component", "left").select("id", F.coalesce("now", "component").alias("component"))
    return tables.write(old.unionByName(moved.join(parts.select("id"), "id", "left_anti")), "parts", tasks)

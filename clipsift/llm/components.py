"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsift.session import durable

FILE_ROWS = 1 << 18  # links in one file of a round, about


def _stars(edges: DataFrame) -> DataFrame:
    """One round of hooking every node's neighbours to its smallest one.

    First the larger neighbours are moved, then the smaller ones and the node itself. A node with
    very many neighbours is a pre-aggregated minimum joined back, never a gathered group. Links may
    repeat between the two steps; they are made distinct once, at the end.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    # A larger neighbour is never its own least one, so each of these has its larger end first.
    down = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every link goes from a node with no other link to the smallest one of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("lower")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("lower"))
    )
    seen = ends.groupBy("node").agg(F.sum("lower").alias("up"), F.count(F.lit(1)).alias("times"))
    return seen.filter("up > 0 AND times > 1").isEmpty()


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b) that is not the smallest of its component: that smallest one.

    ``links`` is read in every column order and more than once, so it should be a written table.
    Large and small stars take turns until all links are settled; each round is written to the
    shared folder, and only a count and a yes or no come to the driver.
    """
    edges = links.filter("a <> b").select("a", "b")
    while True:
        files = -(-edges.count() // FILE_ROWS)
        edges = durable(_stars(edges).coalesce(max(1, files)), "stars")
        if _settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): the smallest node that it reaches."""
    found = roots(links)
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())

"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.llm.runtime import stage_table

#: A key is hot from this share of all rows on, and never with so few rows.
HOT_SHARE, LEAST_HOT = 1e-5, 1000


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one smaller node, which hangs on none: then that is its component."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("up")), F.struct(F.col("b").alias("n"), F.lit(0).alias("up")))).alias("e"))
    node = ends.groupBy("e.n").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("least"))
    return not node.where("up > 1 or up = 1 and least = 0").limit(1).count()


def hot_keys(counted: DataFrame, total: int, least: int = LEAST_HOT) -> DataFrame:
    """Those of ``counted`` (with a row count ``k``) that have more than ``least`` rows and a HOT_SHARE of ``total``.

    There can't be more than 1 / HOT_SHARE of them, so they may be broadcast at any size of the data.
    """
    return counted.where(F.col("k") > max(least, int(total * HOT_SHARE)))


def with_least(edges: DataFrame, total: int) -> DataFrame:
    """Adds to each edge (a, b) the least ``b`` of its ``a``, as ``m``; edges of a hot node stay where they are."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("k"))
    hot = F.broadcast(hot_keys(least, total).select("a", "m"))
    few = edges.join(hot, "a", "left_anti").join(least.drop("k"), "a")
    return few.unionByName(edges.join(hot, "a"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return with_least(both, 2 * total).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    marked = with_least(edges, total)
    moved = marked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(edges.groupBy("a").agg(F.min("b").alias("b")))


def stars(links: DataFrame) -> DataFrame:
    """Edges (a, b) from each node of ``links`` to its component's smallest node, which has none itself.

    Rounds repeat until the edges are stars, a number of rounds that grows with the logarithm of the nodes. Each
    round's edges are written to the shared folder. Loops and repeated links count once; no links give no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage_table(edges, "edges")
    while not _settled(edges):
        large = stage_table(_large_star(edges, edges.count()).distinct(), "edges")
        edges = stage_table(_small_star(large, large.count()).distinct(), "edges")
    return edges


def components(links: DataFrame) -> DataFrame:
    """Smallest node that each node of ``links`` (a, b) reaches, as (node, component); nodes are longs."""
    edges = stars(links)
    node = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return node.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

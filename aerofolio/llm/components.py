"""Connected components of a large graph, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import settle


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step of large-star or small-star over rows ``u > v``.

    Every vertex hangs its larger (large star) or smaller neighbours (small star) on the smallest one. The
    smallest neighbours are written as a table, so the join back has plain exchanges on both sides, and a
    vertex with very many edges is split by AQE.
    """
    seen = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = settle(seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")))
    if large:
        # of vertex u, all v > u go to m; these are the rows turned round
        moved = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return settle(moved.where("u > v").distinct())
    moved = edges.join(least, "u").select("u", "v", "m")
    hung = moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return settle(hung.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct())


def _only_stars(edges: DataFrame) -> bool:
    """Whether each vertex is either a centre or hangs on one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("centre")).union(edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("centre").alias("centre"))
    return seen.where("hangs + centre > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every vertex of ``links(src, dst)`` with a link to another; component is the smallest id.

    Alternates large and small stars till only stars are left (a number of rounds that grows with the logarithm of
    the longest path). Each round is a table in the shared folder, so a lost executor costs one round. Null ends
    and self-links count for nothing; repeated links count once. No vertex list is ever gathered.
    """
    edges = settle(
        links.where("src is not null and dst is not null and src != dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    )
    while not _only_stars(edges):
        edges = _stars(_stars(edges, True), False)
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)

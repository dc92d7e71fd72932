"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlab.session import write_stage


def _hook(edges: DataFrame, both: bool) -> DataFrame:
    """One star step.  ``both``: over all neighbours (large star), else over the smaller ones."""
    around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both else edges
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    out = around.join(least, "a")
    if both:
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id that has a link.

    ``links`` has columns a, b.  Each round joins the links with the smallest
    neighbour of their end and writes the new links to the shared folder; rounds
    grow with the logarithm of the longest chain.  It ends when every link points
    to an id that points to no other.
    """
    edges = write_stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "links")
    while True:
        parents = edges.groupBy("a").agg(F.count("*").alias("n"))
        inner = edges.join(parents.select(F.col("a").alias("b")), "b", "left_semi")
        if not parents.where("n > 1").limit(1).count() and not inner.limit(1).count():
            break
        edges = write_stage(_hook(_hook(edges, True), False), "links")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())

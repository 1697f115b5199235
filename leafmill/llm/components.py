"""Connected components of a table of links, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.session import through_table


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the smallest of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); root is the smallest node it can reach.

    A node with very many links meets its minimum by a map-side combine, and
    the join back splits, as each node stands once on its other side.
    """
    edges, before = through_table(links.filter("a <> b").select("a", "b").distinct(), "links"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now
        edges = through_table(_small_star(_large_star(edges)).filter("a <> b").distinct(), "links")

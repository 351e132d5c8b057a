"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.common import landed


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node that can be reached.

    Alternates the two star operations: large stars hang the larger neighbours of a node on its smallest one, small
    stars hang the smaller ones and the node itself there. Each round is written to the shared folder, so lineage
    stays short; only a count and a checksum reach the driver. The minimum of a node's neighbours is combined map-side
    and written before the edges are joined with it: only then are both sides of the join plain shuffles, and Spark
    splits the edges of a node with very many neighbours.
    Loops and repeated edges do not matter. No edges give no rows.
    """
    edges = (
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    edges = landed(edges, "edges")
    before = _state(edges)
    while True:
        edges = landed(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = landed(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    hung = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = landed(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    others = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()

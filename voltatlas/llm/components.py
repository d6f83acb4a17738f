"""Connected components of a large graph, by alternating star steps; no node's links ever meet in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltatlas.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` from ``a, b``: the least node that each node reaches, for nodes with a link.

    Every step replaces links by links to a smaller node and is written down; the
    number of steps grows with the logarithm of the longest chain.  Links of a
    node to itself, and links given twice, do no harm.
    """
    step = _down(edges.where("a <> b"))
    step, before = written(step, "links"), None
    while True:
        now = _mark(step)
        if now == before:
            return _roots(step)
        before = now
        step = written(_small(_large(step)), "links")


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _down(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return _down(out.where("a <> b"))


def _roots(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )

"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.storage import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node around: larger ones (large star) or smaller ones (small star)."""
    flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges.unionByName(flipped) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = around.join(smallest, "u")
    if large:
        return met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    hung = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smallest.select("u", F.col("m").alias("v")))
    return hung.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edge list (``u``, ``v``): the smallest node of its component.

    Alternating large and small stars; edges are written to the shared folder after each round and
    nodes with many edges are combined before each shuffle. Roots are left out of ``node``.
    """
    edges = stored(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    state = None
    while True:
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now

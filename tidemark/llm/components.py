"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import settle


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Hang the neighbours of every node on the least node among it and them.

    ``both``: all neighbours are seen and the larger ones move (large star);
    else only smaller ones are seen, and they and the node move (small star).
    Sums are combined before the shuffle; the join back is a plain one, whose
    hot nodes the engine can split.
    """
    if both:
        seen = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = (seen.groupBy("a").agg(F.min("b").alias("least"))
             .select(F.col("a").alias("node"), F.least("a", "least").alias("least")))
    moved = seen.join(least, F.col("a") == F.col("node"))
    if both:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = moved.select("a", "b", "least").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
                              F.struct(F.col("a"), F.col("least").alias("b")))).alias("e")).select("e.a", "e.b")
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (least node reachable) for every node of ``links`` (a, b).

    Nodes without links are left out. Rounds go on until the edges stay the same; each is cut with a
    checkpoint, so a lost executor costs one round at most.
    """
    edges = settle(links.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        edges = settle(_star(_star(edges, True), False))
        # an order-free digest of the edge set: one row
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return settle(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
        before = now

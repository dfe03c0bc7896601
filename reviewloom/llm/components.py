"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reviewloom.session import stage


def _staged(edges: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    """The staged edges, and their number and checksum, which are taken while they are written: jobs of their own would cost the driver memory."""
    seen = Observation()
    sums = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("checksum")
    staged = stage(edges.observe(seen, *sums), label)
    return staged, (seen.get["n"], seen.get["checksum"])


def connected(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for all nodes of ``u, v`` edges.

    Every step is a min per node and a join back, both combined or split by Spark where a node has very many edges; each is written to the shared
    folder, which cuts the lineage. The number of steps grows with the logarithm of the nodes.
    """
    edges, now = _staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = (0, None)
    while now != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every larger neighbour of u points to the smallest node around u
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        # small star: u and its smaller neighbours point to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, now = _staged(hooked.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").union(roots.select(F.col("root").alias("node"), "root").distinct())

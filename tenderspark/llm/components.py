"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderspark.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node long, component long): the smallest node reachable, for nodes with an edge.

    Every step groups with partial aggregation and joins back, so a hub is split by adaptive skew joins; the edge
    table is written to the shared folder after each round. Loops and repeated edges are allowed; no edge, no row.
    """
    e = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a != b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        e = written(small.union(low.select("a", F.col("m").alias("b"))).where("a != b").distinct(), "small-star")
        row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1000003), F.countDistinct("a")).first()
        if row[0] == row[2] and tuple(row) == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())
        before = tuple(row)

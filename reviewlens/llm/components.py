"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.session import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node in the links ``a``, ``b``.

    Every step is written to the shared folder, which cuts the lineage. Steps repeat until nothing changes;
    their number grows with the logarithm of the longest path. A node with very many links is split between
    tasks, as both sides of each join are plain exchanges of written tables.
    """
    edges = stage(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(u, v, 1))")).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "lowest")
        large = stage(both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        lowest = stage(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = stage(small.unionByName(lowest.toDF("u", "v")).distinct(), "edges")
    return edges.toDF("node", "component").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

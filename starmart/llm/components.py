"""Connected components of an edge table, by large-star and small-star steps.

Each step is a grouped minimum and a join on the edge table; a hub's edges are combined before they
are shuffled, and its join partition is split. Steps go on until the edges no longer change, with
every step written to the shared folder, so lineage does not grow and lost executors cost one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (u, v: two longs); root is the component's least node."""
    current = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = staged(current.distinct(), "edges")
    before = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            break
        before = mark
        # Large star: each node hands its larger neighbours to its least one.
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large-star")
        # Small star: each node hands its smaller neighbours, and itself, to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        current = staged(small.where("u <> v").distinct(), "small-star")
    # At rest every node but the roots has one edge, to its root.
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.tables import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node that is reachable.

    Each round links the larger neighbours of every node, then the smaller ones, to the least neighbour; it ends when
    nothing changes, after about the logarithm of the longest path. A node with very many neighbours is aggregated
    map-side and its join is split by adaptive execution.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now, state = settled(now, "edges"), None
    while True:
        rows = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == tuple(rows):
            break
        state = tuple(rows)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("_m"))
        large = both.join(least, F.col("u") == F.col("_u")).filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        large = settled(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("_m"))
        inner = large.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u")).filter("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        now = settled(inner.unionByName(least.withColumnRenamed("_m", "v")).distinct(), "edges")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

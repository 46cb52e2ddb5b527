"""Connected components by alternating stars on an edge table; every round is written, nothing is collected.

Large star: each node hands its larger neighbours to the smallest node it knows. Small star: each node hands its smaller
neighbours and itself to the smallest of them. Minima come from partial aggregates and are joined back, so a node
with very many links is never one group in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bizlens.llm.work import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); the root is the component's smallest node."""
    kept = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    kept = written(kept, "cc-edges")
    before = _state(kept)
    while before[0]:
        both = kept.unionByName(kept.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "cc-large")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(smallest.select("u", F.col("m").alias("v"))).distinct())
        kept = written(small, "cc-small")
        after = _state(kept)
        if after == before:
            break
        before = after
    roots = kept.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(kept.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

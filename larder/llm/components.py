"""Connected components of pairs, for any number of them.

Large-star and small-star steps alternate until nothing changes: each links nodes to the least node
they know, by aggregates and joins, so a node with very many partners is reduced in every task first
and its join partitions can be split. Every round is written to the shared folder, and the round
before it deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import drop_written, materialize


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that a pair names and that isn't its own root; roots are least nodes."""
    edges = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges = materialize(edges, "edges")
    seen = _print(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges")
        now = _print(after)
        drop_written(edges)
        edges = after
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return joined.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``u, v``; the component is its smallest node.

    Null ends, loops and repeated edges are allowed and ignored. Each round is written to the shared folder; the number
    of rounds grows with the logarithm of the longest path. Sums per node are combined before the shuffle, and the
    joins are plain equi-joins on stored tables, so a hub is split by adaptive execution.
    """
    clean = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").distinct()
    current, mark = stored(clean, "edges"), None
    while True:
        current = stored(_small_star(_large_star(current)), "stars")
        now = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not now["n"] or (now["n"], now["s"]) == mark:
            break
        mark = (now["n"], now["s"])
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

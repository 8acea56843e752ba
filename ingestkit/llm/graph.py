"""Connected components of a large edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = written(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
    low = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "low")
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    low = written(e.groupBy("a").agg(F.min("b").alias("m")), "low")
    moved = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.withColumnRenamed("m", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); root is the least node reachable.

    Large-star links the larger neighbours of a node to its least neighbour, small-star the smaller
    ones; the edge table never grows and becomes one star per component after a few rounds. Every
    step is written, minima are combined before the shuffle, and joins run between written tables, so
    a hub is split by adaptive execution.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    mark = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")
    seen = e.agg(*mark).first()
    while seen["n"]:
        large = written(_large_star(e).distinct(), "large")
        e = written(_small_star(large).distinct(), "small")
        now = e.agg(*mark).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )

"""Lineage: rows per edge (L7), count reconciliation (L8), two-hop paths and the closure (L9), DQ report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path
from . import audit

# Reconciliation states.
MATCH, MISMATCH, MISSING = "OK", "MISMATCH", "MISSING"

#: Tuning value: up to so many tables on cycles are broadcast to the pairs of a closure.
BROADCAST_IDS = 1 << 20


def reconcile(source_counts: DataFrame, target_counts: DataFrame, keys) -> DataFrame:
    """Per batch, records in the source vs the target, the difference and a status.

    Both inputs are already aggregated per batch (one row per key), so the full
    outer join is one-to-one."""
    keys = list(keys)
    j = source_counts.join(target_counts, keys, "full_outer")
    src, tgt = F.col("source_record_count"), F.col("target_record_count")
    status = F.when(src.isNull() | tgt.isNull(), F.lit(MISSING)).when(src == tgt, F.lit(MATCH)).otherwise(F.lit(MISMATCH))
    return j.select(*keys, src, tgt, (F.coalesce(src, F.lit(0)) - F.coalesce(tgt, F.lit(0))).alias("difference"), status.alias("status"))


def two_hops(edges: DataFrame) -> DataFrame:
    """Upstream -> via -> downstream paths inside one batch (edges joined on batch and table)."""
    a, b = edges.alias("a"), edges.alias("b")
    cond = (F.col("a.batch_id") == F.col("b.batch_id")) & (F.col("a.target_table") == F.col("b.source_table"))
    return a.join(b, cond).select(
        F.col("a.batch_id").alias("batch_id"),
        F.col("a.source_table").alias("upstream"),
        F.col("a.target_table").alias("via"),
        F.col("b.target_table").alias("downstream"),
        F.col("a.source_record_count").alias("records_in"),
        F.col("b.target_record_count").alias("records_out"),
    )


def dq_report(quality_rows: DataFrame, as_of, days: int = 7, top: int = 20) -> DataFrame:
    """The quality summary of the last ``days``, worst rules first (a top-k report)."""
    s = audit.dq_summary(quality_rows, as_of, days=days)
    return s.orderBy(
        F.col("avg_failure_percentage").desc(), F.col("source_name"), F.col("table_name"), F.col("rule_name")
    ).limit(top)


def closure(edges: DataFrame, upstream: str = "source_table", downstream: str = "target_table") -> DataFrame:
    """L9 to any depth: every (upstream, downstream) that is joined by edges, with the least number of hops and
    whether both lie on a common cycle.

    A round that knows all pairs up to n hops finds those of n + 1 to 2 n hops: a pair of exactly n hops and a
    known one behind it, so a chain of n edges takes about log2(n) rounds and meets each of its pairs once.
    Tables are numbered, and a round writes only its new pairs, to the shared work folder, which cuts lineage and
    lets the next one be replanned from its real size. Names come back at the end, and only pairs of which both
    tables lie on cycles are looked up the other way round. Parallel edges and loads of one edge are one edge;
    edges with a null end are left out, and a table that feeds itself is downstream of itself.
    """
    spark = edges.sparkSession
    ends = edges.select(F.col(upstream).cast("string").alias("upstream"), F.col(downstream).cast("string").alias("downstream"))
    ends = ends.where("upstream IS NOT NULL AND downstream IS NOT NULL").distinct()
    root = scratch_path(spark, "closure")
    names = ends.select(F.explode(F.array("upstream", "downstream")).alias("name")).distinct()
    names.withColumn("id", F.monotonically_increasing_id()).write.parquet(f"{root}/names")
    names = spark.read.schema("name string, id long").parquet(f"{root}/names")
    a, b = names.toDF("upstream", "u"), names.toDF("downstream", "v")

    def kept(df: DataFrame, hops: int) -> tuple[DataFrame, int, int]:
        """``df`` written, how many of its pairs have exactly ``hops`` hops, and how many begin where they end."""
        seen = Observation(f"closure_{hops}")
        counts = F.count_if(F.col("hops") == hops).alias("far"), F.count_if(F.col("u") == F.col("v")).alias("round")
        df.observe(seen, *counts).write.parquet(f"{root}/pairs-{hops}")
        return spark.read.schema("u long, v long, hops long").parquet(f"{root}/pairs-{hops}"), seen.get["far"], seen.get["round"]

    reach = 1
    known, frontier, n_circular = kept(ends.join(a, "upstream").join(b, "downstream").select("u", "v", F.lit(1).cast("long").alias("hops")), reach)
    while frontier:
        far = known.where(F.col("hops") == reach).select("u", F.col("v").alias("via"))
        near = known.select(F.col("u").alias("via"), "v", (F.col("hops") + reach).alias("hops"))
        longer = far.join(near, "via").groupBy("u", "v").agg(F.min("hops").alias("hops"))
        new, frontier, more = kept(longer.join(known.select("u", "v"), ["u", "v"], "left_anti"), 2 * reach)
        known, reach, n_circular = known.unionByName(new), 2 * reach, n_circular + more
    out = ["upstream", "downstream", "hops", "in_cycle"]
    if not n_circular:
        return known.join(a, "u").join(b, "v").withColumn("in_cycle", F.lit(False)).select(*out)
    circular = known.where("u = v").select(F.col("u").alias("id"))
    small = F.broadcast(circular) if n_circular <= BROADCAST_IDS else circular
    inner = known.join(small.toDF("u"), "u", "left_semi").join(small.toDF("v"), "v", "left_semi")
    inner.select("u", "v", "hops").write.parquet(f"{root}/circular")
    inner = spark.read.schema("u long, v long, hops long").parquet(f"{root}/circular")
    back = inner.select(F.col("u").alias("v"), F.col("v").alias("u"), F.lit(True).alias("back"))
    inner = inner.join(back, ["u", "v"], "left").join(a, "u").join(b, "v").withColumn("in_cycle", F.coalesce("back", F.lit(False)))
    flagged = names.join(circular.withColumn("round", F.lit(True)), "id", "left").select("id", "name", F.col("round").isNotNull().alias("round"))
    paths = known.join(flagged.toDF("u", "upstream", "from_cycle"), "u").join(flagged.toDF("v", "downstream", "to_cycle"), "v")
    outer = paths.where("NOT (from_cycle AND to_cycle)").withColumn("in_cycle", F.lit(False))
    return outer.select(*out).unionByName(inner.select(*out))


def upstream_of(paths: DataFrame, table: str) -> DataFrame:
    """All tables that ``table`` derives from, by a closure."""
    return paths.where(F.col("downstream") == table).select(F.col("upstream").alias("table_name"), "hops", "in_cycle")


def downstream_of(paths: DataFrame, table: str) -> DataFrame:
    """All tables derived from ``table``, by a closure."""
    return paths.where(F.col("upstream") == table).select(F.col("downstream").alias("table_name"), "hops", "in_cycle")

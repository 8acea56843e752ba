"""Helpers shared by the operators: words, written intermediate tables, row ids, global order."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ingestkit.session import scratch_path

#: The contract's words: runs of anything but space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, for use inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)  # unlike [0], it derives its type only once


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (column names are case-insensitive)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A batch function that gives its memory back when its partition ends: Python workers are used
    again, and what their allocators keep would add up over the stages of a job."""

    @wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return tidied


def give_back() -> None:
    """Returns memory that this process has freed to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def relieve(spark: SparkSession) -> None:
    """Frees what finished jobs have left on the driver and the executors. Spark drops broadcasts, shuffles and
    plans once the JVM has collected them, which a long chain of small jobs leaves to the last moment; and an
    executor's heap keeps the size that its busiest job gave it until it is collected as a whole."""
    give_back()
    spark._jvm.System.gc()
    slots = spark.sparkContext.defaultParallelism
    collected = spark.range(0, slots, 1, slots).select(F.expr("reflect('java.lang.System', 'gc')"))
    collected.write.format("noop").mode("overwrite").save()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back: cuts lineage, fixes row ids,
    and survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a unique long ``name``. Callers write the result before using the id twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def global_order(df: DataFrame, keys: Sequence[Column], sums: Sequence[str] = (), index: str = "idx") -> DataFrame:
    """Rows numbered 0, 1, ... in the order of ``keys``, plus exclusive prefix sums ``before_<c>`` of
    the columns ``sums``.

    Rows are range-partitioned by ``keys`` (a unique tie-break comes last, so a hot key is cut as
    well), summed within each range, and shifted by the totals of the earlier ranges. What meets in
    one task is one row per range.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    tie, part = fresh(df, "tie"), fresh(df, "part")
    df = with_row_id(df, tie)
    order = [*keys, F.col(tie).asc()]
    ranged = df.repartitionByRange(n, *order).withColumn(part, F.spark_partition_id())
    ranged = written(ranged, "ranges")
    totals = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(f"sum_{c}") for c in sums))
    earlier = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        part,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("off_n"),
        *(F.coalesce(F.sum(f"sum_{c}").over(earlier), F.lit(0)).alias(f"off_{c}") for c in sums),
    )
    inside = W.partitionBy(part).orderBy(*order)
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    local = ranged.select(
        *(c for c in df.columns if c != tie),
        part,
        F.row_number().over(inside).alias("local_n"),
        *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"local_{c}") for c in sums),
    )
    # one row per range: at most spark.sql.shuffle.partitions rows
    return local.join(F.broadcast(offsets), part).select(
        *(c for c in df.columns if c != tie),
        (F.col("off_n") + F.col("local_n") - 1).cast("long").alias(index),
        *((F.col(f"off_{c}") + F.col(f"local_{c}")).cast("long").alias(f"before_{c}") for c in sums),
    )

"""Layer tables on plain parquet (K1-K3, K6).

Every table is a folder of parquet files written with dynamic partition overwrite, so a retried write
replaces the partitions it wrote before and touches no other. Its layout (columns and types) is kept beside
it (``Layout``) and is what it is read by: a file of an older layout gives nulls for later columns and
promotes narrower types, and no reader guesses from one file.

Bronze, quarantine and append-only silver are partitioned by batch. Silver tables that change are partitioned
by a hash bucket of the key (``KeyedTable``, ``HistoryTable``): a batch reads and rewrites only the buckets
that hold its keys. Parquet has no snapshots: who reads while a load commits may see some buckets before and
some after it. With a row-level table format on the classpath, ``DataFrame.mergeInto`` is the replacement.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import evolution, scd
from .session import path_exists, read_small, small_files, write_small

#: Buckets of a new keyed table. A bucket is the least that a late row rewrites, so a table of n bytes wants
#: about n / 1 GB of them; the number is fixed with the table's first batch.
BUCKETS = 16
BUCKET = "_bucket"
LANDED = "_landed_batch"


class Layout:
    """The stored columns of a table, as small JSON files beside its folder; the last one counts."""

    def __init__(self, spark: SparkSession, table_path: str):
        self.spark = spark
        self.path = f"{table_path.rstrip('/')}__layout"

    def read(self) -> tuple[T.StructType, T.StructType, int] | None:
        """(stored columns, columns of the last batch, buckets); None before the first batch."""
        names = [n for n in small_files(self.spark, self.path) if not n.startswith(".")]
        if not names:
            return None
        r = json.loads(read_small(self.spark, f"{self.path}/{names[-1]}"))
        return T.StructType.fromJson(r["stored"]), T.StructType.fromJson(r["batch"]), r["buckets"]

    def save(self, stored: T.StructType, batch: T.StructType, batch_id: str, buckets: int = 0) -> None:
        row = {"batch_id": batch_id, "stored": stored.jsonValue(), "batch": batch.jsonValue(), "buckets": buckets}
        write_small(self.spark, f"{self.path}/{time.time_ns():020d}.json", json.dumps(row))

    def grown(self, batch: T.StructType, batch_id: str, buckets: int = 0) -> tuple[T.StructType, T.StructType | None, int]:
        """The layout with ``batch`` merged in, stored if it or the batch's columns are new: (stored columns,
        columns of the batch before, None at first, buckets)."""
        last = self.read()
        if last is None:
            stored = T.StructType([T.StructField(f.name, f.dataType) for f in batch.fields])
            self.save(stored, stored, batch_id, buckets)
            return stored, None, buckets
        stored = evolution.merged(last[0], batch)
        if _plain(last[1]) != _plain(batch) or _plain(stored) != _plain(last[0]):
            self.save(stored, batch, batch_id, last[2])
        return stored, last[1], last[2]


def _plain(schema: T.StructType) -> str:
    """Names and types only: nullability is no change of layout."""
    return schema.simpleString()


def read_table(spark: SparkSession, path: str, extra: Sequence[tuple[str, str]] = ()) -> DataFrame | None:
    """A table by its stored layout (``extra``: partition columns outside it); None before its first batch."""
    last = Layout(spark, path).read()
    if last is None:
        return None
    schema = T.StructType([*last[0].fields, *(T.StructField(n, T.StringType() if t == "string" else T.IntegerType()) for n, t in extra)])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _put(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_bronze(df: DataFrame, path: str) -> None:
    """K1: append a batch, partitioned by ``_batch_id``; a retry overwrites only its own batch."""
    _put(df, path, "_batch_id")


def write_quarantine(df: DataFrame, path: str) -> None:
    """K2: failing rows partitioned by ``batch_id``; a retry replaces its own batch's rows."""
    _put(df, path, "batch_id")


def write_gold(df: DataFrame, path: str) -> DataFrame:
    """K6: a gold table is rebuilt from silver and replaces the last one."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row's key; a null key has one too."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int").alias(BUCKET)


class _Bucketed:
    """What the keyed tables share. Buckets are small whole numbers, at most ``buckets`` of them, and the
    only thing about a batch that reaches the driver."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets

    def _in(self, df: DataFrame, touched: Sequence[int]) -> DataFrame:
        """Rows of some buckets: a filter on the partition column, so other folders are not listed."""
        return df.where(F.col(BUCKET).isin([int(b) for b in touched]))

    def _store(self, rows: DataFrame, path: str, *partitions: str) -> None:
        # one task per bucket and partition as a rule; adaptive execution splits those of a hot key by size
        _put(rows.hint("rebalance", BUCKET), path, BUCKET, *partitions)


class KeyedTable(_Bucketed):
    """K3 for SCD1, UPSERT and SCD3: one row per key. ``apply`` gives ``change(target, batch)`` the stored
    rows of the batch's buckets and writes these buckets again. With ``feed`` it also keeps, by batch, the rows
    that changed: their images before (``_op`` -1) and after (``_op`` 1); they are written before the buckets,
    so a retry of a batch whose buckets are half written finds them and leaves them as they are."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = BUCKETS, feed: bool = False):
        super().__init__(spark, root, keys, buckets)
        self.feed = f"{self.root}__changes" if feed else None

    def read(self) -> DataFrame | None:
        df = read_table(self.spark, self.root, [(BUCKET, "int")])
        return None if df is None else df.drop(BUCKET)

    def apply(self, batch: DataFrame, batch_id: str, change: Callable[[DataFrame | None, DataFrame], DataFrame]) -> DataFrame:
        last = Layout(self.spark, self.root).read()
        buckets = last[2] if last else self.buckets
        target = None
        if last:
            touched = [r[0] for r in batch.select(bucket_of(self.keys, buckets)).distinct().collect()]
            layout = evolution.merged(last[0], batch.schema)
            own = {f.name for f in last[0].fields if f.name.startswith("_scd_") or f.name.endswith(("_previous", "_change_date"))}
            own -= set(batch.columns)  # what the change itself adds
            batch = evolution.conform(batch, T.StructType([f for f in layout.fields if f.name not in own]))
            stored = self._in(read_table(self.spark, self.root, [(BUCKET, "int")]), touched).drop(BUCKET)
            target = evolution.conform(stored, layout)
        out = change(target, batch)
        if target is not None and {"_scd_action", "_scd_batch_id"} <= set(out.columns):
            # a row this very batch wrote before a retry keeps its label
            mine = target.where(F.col("_scd_batch_id") == batch_id).select(*self.keys, F.col("_scd_action").alias("_done"))
            out = scd._join_keys(out, mine, self.keys, "left").withColumn("_scd_action", F.coalesce("_done", "_scd_action")).drop("_done")
        Layout(self.spark, self.root).grown(out.schema, batch_id, buckets)
        if self.feed and not path_exists(self.spark, f"{self.feed}/_batch_id={batch_id}"):
            images = _images(out.limit(0) if target is None else target, out, self.keys).withColumn("_batch_id", F.lit(batch_id))
            Layout(self.spark, self.feed).grown(images.schema, batch_id)
            _put(images, self.feed, "_batch_id")
        self._store(out.withColumn(BUCKET, bucket_of(self.keys, buckets)), self.root)
        return self.read()

    def changes(self, batch_id: str) -> DataFrame:
        """Images of the rows that a batch changed: only its own folder is read."""
        return read_table(self.spark, self.feed).where(F.col("_batch_id") == batch_id).drop("_batch_id")


def _images(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``before`` that are not in ``after`` as they were (``_op`` -1), and the other way round (1)."""
    columns = after.columns
    value = F.struct(*[c for c in columns if not c.startswith("_scd_")])

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(k) for k in keys], F.struct(*columns).alias(name), F.xxhash64(value).alias(f"{name}_hash"))

    old, new = packed(before.select(*columns), "_old"), packed(after, "_new")
    both = old.join(new, [old[k].eqNullSafe(new[k]) for k in keys], "full_outer")
    # equal hashes are checked on the values, so no change is missed
    same = F.coalesce((F.col("_old_hash") == F.col("_new_hash")) & F.to_json("_old").eqNullSafe(F.to_json("_new")), F.lit(False))
    images = F.array(F.struct(F.lit(-1).alias("_op"), F.col("_old").alias("_row")), F.struct(F.lit(1).alias("_op"), F.col("_new").alias("_row")))
    rows = both.where(~same).select(F.inline(F.filter(images, lambda i: i["_row"].isNotNull())))
    return rows.select("_row.*", "_op")


class HistoryTable(_Bucketed):
    """K3 for SCD2. ``root``/log holds all rows ever loaded, by bucket and batch; ``root``/versions the
    versions, by bucket and whether they are open. A load lands its batch and rebuilds, from the log, the
    versions of the buckets that hold its keys: a bucket is a function of its log alone, so late rows, repeats
    and retries need no care, and neither files nor log rows of other buckets are read. (The number of
    versions of a key never falls, so a rebuilt bucket overwrites both its partitions.) A version has the
    batch id of the row that opened it, of equal rows the least. A batch with columns the log did not have
    rebuilds all buckets once, as it changes what makes a version.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], tracked: Sequence[str] | None = None,
                 order: Sequence[str] = (), buckets: int = BUCKETS):
        super().__init__(spark, root, keys, buckets)
        self.tracked, self.order = tracked, list(order)
        self.log, self.versions = f"{self.root}/log", f"{self.root}/versions"

    def _tracked(self, columns: Sequence[str]) -> list[str]:
        if self.tracked is not None:
            return list(self.tracked)
        return [c for c in columns if c not in self.keys and c not in self.order and not c.startswith("_")]

    def _versions(self) -> DataFrame | None:
        last = Layout(self.spark, self.versions).read()
        if last is None:
            return None
        # partition values are text in folder names; compared as text, the filter prunes them
        schema = T.StructType([*(f for f in last[0].fields if f.name != "_scd_is_current"), T.StructField(BUCKET, T.IntegerType()),
                               T.StructField("_scd_is_current", T.StringType())])
        if not path_exists(self.spark, self.versions):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.versions)

    def _shown(self, df: DataFrame | None) -> DataFrame | None:
        if df is None:
            return None
        names = Layout(self.spark, self.versions).read()[0].names
        return df.withColumn("_scd_is_current", F.col("_scd_is_current") == "true").select(*names)

    def read(self) -> DataFrame | None:
        return self._shown(self._versions())

    def current(self) -> DataFrame | None:
        """Open versions: only their partitions are read."""
        df = self._versions()
        return self._shown(None if df is None else df.where(F.col("_scd_is_current") == "true"))

    def landed(self) -> DataFrame | None:
        """All rows ever loaded, with their batch."""
        return read_table(self.spark, self.log, [(LANDED, "string"), (BUCKET, "int")])

    def load(self, batch: DataFrame, batch_id: str) -> DataFrame:
        """Lands ``batch`` and rebuilds the buckets of its keys; the whole history at the end."""
        before = Layout(self.spark, self.log).read()
        stored, _, buckets = Layout(self.spark, self.log).grown(batch.schema, batch_id, self.buckets)
        batch = evolution.conform(batch, stored)
        seen = Observation(f"landed_{batch_id}")
        marked = batch.withColumns({BUCKET: bucket_of(self.keys, buckets), LANDED: F.lit(batch_id)})
        self._store(marked.observe(seen, F.collect_set(BUCKET).alias("touched")), self.log, LANDED)
        touched = sorted(seen.get.get("touched") or [])
        if before is not None and _plain(before[0]) != _plain(stored):
            touched = list(range(buckets))
        versions = self.built(self._in(self.landed(), touched))
        Layout(self.spark, self.versions).grown(versions.drop(BUCKET).schema, batch_id, buckets)
        if touched:
            self._store(versions, self.versions, "_scd_is_current")
        return self.read()

    def built(self, log: DataFrame) -> DataFrame:
        """The versions of log rows (with their batch and bucket)."""
        business = [c for c in log.columns if c not in (BUCKET, LANDED)]
        tracked = self._tracked(business)
        # a bucket is a function of the key: with it as a key the rows are dealt by it once, for window and write
        history = scd.scd2_history(log, self.keys, tracked, self.order, tie=[LANDED])
        return history.select(*business, F.col(LANDED).alias("_scd_batch_id"), BUCKET,
                              *[c for c in history.columns if c.startswith("_scd_")])


class BatchPartitionedTable:
    """Append-only layer table (APPEND, SCD0): each batch writes only its new rows
    into its own ``_scd_batch_id`` partition with dynamic overwrite, so a retry
    replaces its partition and a load costs O(batch), never a table rewrite."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def read(self) -> DataFrame | None:
        return read_table(self.spark, self.root)

    def read_without(self, batch_id: str) -> DataFrame | None:
        """What other batches wrote: the target a (possibly retried) batch is compared with."""
        df = self.read()
        return None if df is None else df.where(F.col("_scd_batch_id") != F.lit(batch_id))

    def add(self, rows: DataFrame, batch_id: str) -> DataFrame:
        rows = rows.withColumn("_scd_batch_id", F.lit(batch_id))
        stored, _, _ = Layout(self.spark, self.root).grown(rows.schema, batch_id)
        _put(evolution.conform(rows, stored), self.root, "_scd_batch_id")
        return self.read()

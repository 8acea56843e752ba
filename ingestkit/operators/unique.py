"""Unique keys across loads (Q8, D16): a row whose key an earlier load, or an earlier row of its own load, has
brought is a duplicate.

All keys loaded so far are kept below a root, by a hash bucket of the key and by batch, next to one Bloom
filter per bucket. A batch is tested against the filters first, in the map side of the plan: a miss is certain
to be new and goes no further. Only hits (duplicates, and about one in a hundred others) are shuffled to the
exact semi-join, which reads the key folders of their buckets alone. Filters are blocked: a key sets its bits
within one block of 32,768, so a filter is a table of (block, words of 64 bits) rows that is built, merged and
probed by built-in functions, and a key probes one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from ..store import BUCKET, Layout, _put, read_table

#: Bits of a block, bits set per key, and bits per expected key.
BLOCK_BITS = 32_768
PROBES = 7
BITS_PER_KEY = 10
#: Keys the filters are made for; more only let more rows through to the exact test.
EXPECTED_KEYS = 1 << 20
#: Filters up to this size are broadcast; larger ones meet the batch in a join by block.
BROADCAST_BYTES = 64 << 20

IN_BATCH, IN_LOAD = "key repeated in the load", "key loaded before"


class KnownKeys:
    """Keys of all loads below ``root``."""

    def __init__(self, spark: SparkSession, root: str, keys, buckets: int = 16, expected_keys: int = EXPECTED_KEYS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        need = -(-expected_keys * BITS_PER_KEY // BLOCK_BITS)
        self.blocks = -(-max(need, 1) // buckets) * buckets
        self.stored, self.filters = f"{self.root}/keys", f"{self.root}/filters"

    def _hash(self, seed: int) -> Column:
        return F.xxhash64(F.lit(seed), *[F.col(k).cast("string") for k in self.keys])

    def _block(self) -> Column:
        return F.pmod(self._hash(0), F.lit(self.blocks)).cast("int")

    def _places(self) -> Column:
        """Bits of the key in its block: steps of one hash from another."""
        first, step = F.pmod(self._hash(1), F.lit(BLOCK_BITS)), F.pmod(self._hash(2), F.lit(BLOCK_BITS // 2)) * 2 + 1
        return F.array(*[F.pmod(first + step * i, F.lit(BLOCK_BITS)) for i in range(PROBES)])

    def _filters(self) -> DataFrame | None:
        if not path_exists(self.spark, self.filters):
            return None
        return self.spark.read.schema(f"block int, bits array<long>, {BUCKET} int").parquet(self.filters)

    def _probed(self, keyed: DataFrame, filters: DataFrame) -> DataFrame:
        """``keyed`` with ``_block`` and ``_held``: the filters may hold the row's key."""
        filters = filters.select(F.col("block").alias("_block"), "bits")
        if self.blocks * BLOCK_BITS // 8 <= BROADCAST_BYTES:
            filters = F.broadcast(filters)
        probed = keyed.withColumns({"_block": self._block(), "_places": self._places()}).join(filters, "_block", "left")

        def bit(place: Column) -> Column:
            # a word shifted left until the bit is its sign: one built-in step, no text in between
            word = F.get("bits", F.shiftright(place, 6).cast("int"))
            return F.call_function("shiftleft", word, (F.lit(63) - place % 64).cast("int")) < 0

        held = reduce(lambda a, b: a & b, [bit(F.col("_places")[i]) for i in range(PROBES)])
        return probed.withColumn("_held", F.coalesce(held, F.lit(False))).drop("_places", "bits")

    def hits(self, keyed: DataFrame) -> DataFrame | None:
        """Rows whose key the filters may hold (all that they hold, and few others); None when nothing is known."""
        filters = self._filters()
        return None if filters is None else self._probed(keyed, filters).where("_held").drop("_held")

    def marked(self, batch: DataFrame, batch_id: str, row_id: str, order=(), unordered=()) -> DataFrame:
        """``batch`` with ``reason``: why the row is a duplicate, else null. The first row of a key, by ``order`` and
        then all columns but ``unordered``, is the one that stays; a row with a null in its key is none of this rule's business.

        The keys of the batch are written once, each with its first row, its number of rows and what the filters say,
        and the rows meet only those keys that may be duplicates, in one join."""
        present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        rest = [c for c in batch.columns if c not in (*self.keys, *order, *unordered, row_id) and _orderable(batch.schema[c].dataType)]
        first = batch.where(present).groupBy(*self.keys).agg(
            F.min(F.struct(*order, *rest, row_id)).alias("_first"), F.count(F.lit(1)).alias("_n")
        )
        keyed = first.select(*self.keys, F.col(f"_first.{row_id}").alias("_stays"), "_n")
        filters = self._filters()
        if filters is None:
            keyed = keyed.withColumns({"_block": self._block(), "_held": F.lit(False)})
        else:
            keyed = self._probed(keyed, filters)
        keyed = keyed.withColumn(BUCKET, F.pmod("_block", F.lit(self.buckets))).drop("_block")
        # folders of the hits' buckets; at most ``buckets`` numbers reach the driver
        seen, path = Observation(f"hits_{batch_id}"), f"{self.root}/batch"
        keyed.observe(seen, F.collect_set(F.when(F.col("_held"), F.col(BUCKET))).alias("b")).write.mode("overwrite").parquet(path)
        keyed = self.spark.read.schema(keyed.schema).parquet(path)
        suspects = keyed.where("NOT _held AND _n > 1").select(*self.keys, "_stays", F.lit(False).alias("_known"))
        buckets = seen.get["b"] or []
        if buckets:
            before = read_table(self.spark, self.stored, [(BUCKET, "int"), ("_batch", "string")])
            before = before.where(F.col(BUCKET).isin(buckets) & (F.col("_batch") != batch_id))
            before = before.select(*self.keys).distinct().withColumn("_known", F.lit(True))
            near = keyed.where("_held").join(before, self.keys, "left").where("_known OR _n > 1")
            suspects = suspects.unionByName(near.select(*self.keys, "_stays", F.coalesce("_known", F.lit(False)).alias("_known")))
        reason = F.when(F.col("_known"), F.lit(IN_LOAD)).when(F.col(row_id) != F.col("_stays"), F.lit(IN_BATCH))
        return batch.join(suspects, self.keys, "left").select(*[batch[c] for c in batch.columns], reason.alias("reason"))

    def duplicates(self, batch: DataFrame, batch_id: str, row_id: str, order=()) -> DataFrame:
        """(row_id, reason) of the duplicate rows of ``batch``."""
        return self.marked(batch, batch_id, row_id, order).where("reason IS NOT NULL").select(row_id, "reason")

    def add(self, rows: DataFrame, batch_id: str) -> None:
        """The keys of ``rows`` become known under ``batch_id``; a retry writes the same again."""
        bucket = F.pmod(self._block(), F.lit(self.buckets)).cast("int")
        keys = rows.select(*self.keys).distinct().withColumns({BUCKET: bucket, "_batch": F.lit(batch_id)})
        Layout(self.spark, self.stored).grown(rows.select(*self.keys).schema, batch_id, self.buckets)
        _put(keys.hint("rebalance", BUCKET), self.stored, BUCKET, "_batch")
        mine = read_table(self.spark, self.stored, [(BUCKET, "int"), ("_batch", "string")]).where(F.col("_batch") == batch_id)
        place = F.col("place")
        bits = mine.select(self._block().alias("block"), F.explode(self._places()).alias("place")).select(
            "block", F.shiftright(place, 6).cast("int").alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bits"),
        )
        old = self._filters()
        if old is not None:
            bits = bits.unionByName(old.select("block", F.posexplode("bits").alias("word", "bits")))
        # words of 64 bits are merged by a plain aggregation, combined before the shuffle
        words = bits.groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
        held = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
        every = F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1))
        fresh = held.select("block", F.transform(every, lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("bits"))
        _put(fresh.withColumn(BUCKET, F.pmod("block", F.lit(self.buckets)).cast("int")).hint("rebalance", BUCKET), self.filters, BUCKET)


def _orderable(kind) -> bool:
    from pyspark.sql import types as T

    return not isinstance(kind, (T.MapType, T.VariantType))

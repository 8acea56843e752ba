"""Streaming ingestion.

Every stream writes through ``foreachBatch`` with a checkpoint below the shared
work folder, so a restarted query resumes after the last committed micro-batch
and never re-reads a file or offset. Sinks are keyed by the micro-batch id
(``<query>-<epoch>``): the snapshot table skips an id it already committed and
bronze partitions are overwritten per batch, so a replayed batch is applied
once. Counts come from the rows written (``observe``), never from an extra
``count()`` of the stream.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType, VariantType

from ..operators import enrich, quality
from ..session import path_exists
from ..store import HistoryTable

# Trigger intervals of the shipped configuration.
STREAM_TRIGGER = "1 minute"
BATCH_TRIGGER = "1 hour"
# Why ``dedup_sink`` set a row aside.
REASON = "_repeat_reason"


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def run_available_now(stream: DataFrame, checkpoint: str, fn, name: str) -> None:
    """Process what is there now through ``fn(batch_df, epoch_id)``, then stop."""
    q = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(fn)
    handle = _trigger(q, True, BATCH_TRIGGER).start()
    handle.awaitTermination()
    if handle.exception() is not None:
        raise handle.exception()


def start_continuous(stream: DataFrame, checkpoint: str, fn, name: str, interval: str = STREAM_TRIGGER):
    """A long-running stream with a processing-time trigger."""
    q = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(fn)
    return _trigger(q, False, interval).start()


def bronze_sink(path: str, rules=(), run_ts=None, name: str = "bronze", log=None, source: str = "", table: str = "", spec=None):
    """One write per micro-batch: rows marked with the error rules they
    fail, partitioned by (_batch_id, _is_quarantined), so good rows and
    quarantine come from a single pass. Row, quarantine and per-rule counts are
    observed on that same write; with an ``AuditLog`` each micro-batch gets a
    run row and one quality row per rule; with ``spec`` (a ResolvedTable) rows get
    the audit columns. Returns the sink and a list
    collecting (batch_id, rows, quarantined) per batch."""
    seen: list[tuple[str, int, int]] = []
    rules = list(rules)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch_id = f"{name}-{epoch_id}"
        at = run_ts or datetime.now()
        if log is not None:
            log.log_batch_start(batch_id, source, table, at)
        if spec is not None:
            batch = enrich.add_audit_columns(batch, spec, batch_id, at)
        observed, counter, expanded = quality.observe_rules(batch, rules, f"{name}_{epoch_id}")
        marked = quality.with_failed_rules(observed, rules).withColumns(
            {"_is_quarantined": F.size(quality.FAILED) > 0, "_batch_id": F.lit(batch_id)}
        )
        (
            marked.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch_id", "_is_quarantined")
            .parquet(path)
        )
        rows, bad, per_rule = quality.observed_metrics(counter, expanded)
        seen.append((batch_id, rows, bad))
        if log is not None:
            log.log_rule_counts(batch_id, source, table, per_rule, at)
            log.log_batch_success(batch_id, source, table, read=rows, written=rows - bad, at=datetime.now(), start=at)

    return sink, seen


def read_bronze(spark, path: str, quarantined: bool = False) -> DataFrame:
    """Good rows (or quarantined rows) of a bronze table written by ``bronze_sink``."""
    df = spark.read.parquet(path).where(F.col("_is_quarantined") == F.lit(quarantined))
    return df.drop("_is_quarantined", quality.FAILED) if not quarantined else df


def scd2_sink(table: HistoryTable, name: str = "scd2"):
    """Land each micro-batch in an SCD2 table and rebuild the buckets of its keys; late rows are placed
    by the log of all landed rows, and a replayed batch lands in its own place."""

    def sink(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            table.load(batch, f"{name}-{epoch_id}")

    return sink


def dedup_sink(path: str, event_time: str, keys, delay: str, name: str = "dedup", slice_days: int = 1):
    """Set aside rows whose key was seen within ``delay`` of them, in this micro-batch or an earlier
    one; a chain of such rows is one event, whose first row to arrive stays.

    A row's own age never matters: a late row is compared with the rows landed around its time, however
    old, so no row is dropped for being later than a watermark. One write holds all rows, partitioned by
    (_slice, _batch_id, _is_repeat), a slice being ``slice_days`` days; a repeat carries its reason. Of the rows
    landed before, a batch reads only the slices that its own rows, give or take ``delay``, fall on, and of those
    only keys and times.

    Batch and landed rows are laid out in one stream per key and slot of time (a slot is at least twice
    ``delay`` long; a row within reach of the next or the last slot has a copy there), and each batch row
    takes the nearest time before it in the batch, and before and after it among the landed rows. So no
    row is paired with another, and a hot key is split by time. NULL keys are one key, and a row without
    an event time is never a repeat."""
    keys = list(keys)
    span = F.expr(f"INTERVAL {delay}")

    def micros(c):
        return F.unix_micros(c.cast("timestamp"))

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch_id = f"{name}-{epoch_id}"
        spark, t = batch.sparkSession, F.col(event_time)
        columns = batch.columns
        reach = micros(F.timestamp_micros(F.lit(0)) + span)
        slot_of = lambda m: F.floor(m / (reach * 2 + 1)).cast("long")
        slice_of = lambda c: F.floor(F.unix_date(F.to_date(c)) / slice_days).cast("int")

        def own(at, mine, landed):
            """Rows of the stream: a batch row in its slot, else only its time, in the slots it reaches."""
            return [at.alias("_at"), mine.alias("_mine"), landed.alias("_landed")]

        timed = batch.where(t.isNotNull()).withColumn("_at", micros(t))
        row = F.struct(*columns)
        none = F.lit(None).cast(batch.select(row).schema[0].dataType)
        at = F.col("_at")
        here = timed.select(*keys, slot_of(at).alias("_slot"), *own(at, F.lit(True), F.lit(False)), row.alias("_row"))
        ahead = timed.where(slot_of(at) != slot_of(at + reach)).select(
            *keys, slot_of(at + reach).alias("_slot"), *own(at, F.lit(True), F.lit(False)), none.alias("_row")
        )
        stream = here.unionByName(ahead)
        if path_exists(spark, path):
            # one number per slice of the batch's span reaches the driver
            near = F.explode(F.sequence(slice_of(t - span), slice_of(t + span)))
            slices = [r[0] for r in timed.select(near.alias("s")).distinct().collect()]
            schema = StructType([*batch.schema.fields, StructField("_slice", IntegerType()), StructField("_batch_id", StringType())])
            landed = spark.read.schema(schema).parquet(path)
            landed = landed.where(F.col("_slice").isin(slices) & (F.col("_batch_id") != F.lit(batch_id)))
            landed = landed.select(*keys, micros(t).alias("_at"))
            slots = F.explode(F.sequence(slot_of(at - reach), slot_of(at + reach)))
            stream = stream.unionByName(landed.select(*keys, slots.alias("_slot"), *own(at, F.lit(False), F.lit(True)), none.alias("_row")))
        # landed rows come before batch rows of the same time; equal batch rows are interchangeable
        order = [at, F.col("_mine"), F.col("_row").isNotNull(), *[F.col(f"_row.{c}") for c in columns if _orderable(batch, c)]]
        w = Window.partitionBy(*keys, "_slot").orderBy(*order)
        before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)

        def nearest(flag, frame, pick):
            return pick(F.when(F.col(flag), at), ignorenulls=True).over(frame)

        seen = stream.withColumns(
            {
                "_batch_before": nearest("_mine", before, F.last),
                "_landed_before": nearest("_landed", before, F.last),
                "_landed_after": nearest("_landed", after, F.first),
            }
        ).where(F.col("_row").isNotNull())
        known = (at - F.col("_landed_before") <= reach) | (F.col("_landed_after") - at <= reach)
        reason = F.when(known, F.lit(f"key landed before within {delay}")).when(
            at - F.col("_batch_before") <= reach, F.lit(f"key repeated in the batch within {delay}")
        )
        marked = seen.select("_row.*", reason.alias(REASON)).unionByName(
            batch.where(t.isNull()).withColumn(REASON, F.lit(None).cast("string"))
        )
        (
            marked.withColumns({"_slice": slice_of(t), "_batch_id": F.lit(batch_id), "_is_repeat": F.col(REASON).isNotNull()})
            .hint("rebalance", "_slice")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_slice", "_batch_id", "_is_repeat")
            .parquet(path)
        )

    return sink


def _orderable(df: DataFrame, column: str) -> bool:
    return not isinstance(df.schema[column].dataType, (MapType, VariantType))


def read_deduped(spark, path: str, repeats: bool = False) -> DataFrame:
    """Rows kept (or the repeats with their reason) of a table written by ``dedup_sink``."""
    df = spark.read.parquet(path).where(F.col("_is_repeat") == F.lit(repeats)).drop("_is_repeat", "_slice")
    return df if repeats else df.drop(REASON)


def append_sink(path: str, name: str = "append"):
    """Append rows that are final (e.g. after deduplication), one partition per
    micro-batch id: a replayed batch overwrites its own partition."""

    def sink(batch: DataFrame, epoch_id: int) -> None:
        (
            batch.withColumn("_batch_id", F.lit(f"{name}-{epoch_id}"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch_id")
            .parquet(path)
        )

    return sink

"""Audit log: run events, quality rows, schema changes, lineage, and reports.

Parquet tables refuse UPDATE, so a run is a series of appended state events
(RUNNING, then SUCCESS or FAILED) keyed by (batch_id, source_name, table_name);
its current state is the latest event (A9), found by one aggregation that
combines map-side. Rows are appended as typed data, never as SQL text.

Reports take the event or quality DataFrame and an explicit ``as_of`` so their
answers are reproducible.
"""

from __future__ import annotations

import time
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import exact_mean
from ..session import delete_folder, folders, path_exists
from ..spec import PIPELINE_VERSION

# Audit table schemas and run states.
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
EPOCH = "1970-01-01 00:00:00"

RUN_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("source_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("event_seq", T.LongType(), False),
        T.StructField("run_start_time", T.TimestampNTZType(), True),
        T.StructField("run_end_time", T.TimestampNTZType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("records_read", T.LongType(), True),
        T.StructField("records_written", T.LongType(), True),
        T.StructField("records_failed", T.LongType(), True),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("watermark_value", T.TimestampNTZType(), True),
        T.StructField("pipeline_version", T.StringType(), True),
        T.StructField("spark_version", T.StringType(), True),
        T.StructField("cluster_id", T.StringType(), True),
    ]
)
QUALITY_SCHEMA = T.StructType(
    [
        T.StructField("check_id", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("source_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("check_timestamp", T.TimestampNTZType(), True),
        T.StructField("rule_name", T.StringType(), False),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("check_type", T.StringType(), True),
        T.StructField("records_checked", T.LongType(), True),
        T.StructField("records_passed", T.LongType(), True),
        T.StructField("records_failed", T.LongType(), True),
        T.StructField("failure_percentage", T.DoubleType(), True),
        T.StructField("severity", T.StringType(), True),
        T.StructField("is_quarantined", T.BooleanType(), True),
    ]
)
SCHEMA_CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("evolution_id", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("source_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("change_timestamp", T.TimestampNTZType(), True),
        T.StructField("previous_schema", T.StringType(), True),
        T.StructField("new_schema", T.StringType(), True),
        T.StructField("change_type", T.StringType(), True),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("previous_type", T.StringType(), True),
        T.StructField("new_type", T.StringType(), True),
    ]
)
LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("lineage_id", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("source_name", T.StringType(), False),
        T.StructField("source_table", T.StringType(), True),
        T.StructField("target_catalog", T.StringType(), True),
        T.StructField("target_schema", T.StringType(), True),
        T.StructField("target_table", T.StringType(), True),
        T.StructField("operation", T.StringType(), True),
        T.StructField("operation_timestamp", T.TimestampNTZType(), True),
        T.StructField("source_record_count", T.LongType(), True),
        T.StructField("target_record_count", T.LongType(), True),
        T.StructField("transformation_logic", T.StringType(), True),
    ]
)
TABLES = {
    "audit_batch_runs": RUN_EVENT_SCHEMA,
    "audit_data_quality": QUALITY_SCHEMA,
    "audit_schema_evolution": SCHEMA_CHANGE_SCHEMA,
    "audit_lineage": LINEAGE_SCHEMA,
}
#: Folder column of the tables, and the times that give a row its day (the first that is not null).
DAY = "_day"
TIMES = {
    "audit_batch_runs": ("run_start_time", "run_end_time"),
    "audit_data_quality": ("check_timestamp",),
    "audit_schema_evolution": ("change_timestamp",),
    "audit_lineage": ("operation_timestamp",),
}
RUN_KEY = ("batch_id", "source_name", "table_name")


def _ts(v):
    if v is None or isinstance(v, datetime):
        return v
    return datetime.fromisoformat(str(v))


def rows_frame(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small frame of literal rows, built on the JVM (no Python rows to ship to executors)."""

    def lit(v, f):
        return F.lit(v.isoformat(sep=" ") if isinstance(v, datetime) else v).cast(f.dataType).alias(f.name)

    structs = [F.struct(*[lit(v, f) for v, f in zip(row, schema.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def one_row(spark: SparkSession, values, schema: T.StructType) -> DataFrame:
    """A one-row frame of literals, built on the JVM (no Python rows to ship to executors)."""
    cols = []
    for v, f in zip(values, schema.fields):
        lit = F.lit(v.isoformat(sep=" ") if isinstance(v, datetime) else v)
        cols.append(lit.cast(f.dataType).alias(f.name))
    return spark.range(1).select(*cols)


class AuditLog:
    """Four append-only parquet tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str, cluster_id: str = "local"):
        self.spark = spark
        self._last_event = 0
        self.root = root.rstrip("/")
        self.cluster_id = cluster_id

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def ensure(self) -> None:
        """K7: create the four tables when missing (empty parquet with the schema)."""
        for name, schema in TABLES.items():
            if not self._exists(name):
                self.spark.createDataFrame([], schema).withColumn(DAY, F.lit(None).cast("date")).write.mode("append").partitionBy(DAY).parquet(self.path(name))

    def _exists(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def table(self, name: str) -> DataFrame:
        rows = self.spark.read.schema(TABLES[name]).parquet(self.path(name)).select(*TABLES[name].names)
        return latest_checks(rows) if name == "audit_data_quality" else rows

    def append(self, name: str, df: DataFrame) -> None:
        """K8: append rows (a retry appends the same event again; readers take the latest), in a folder per day."""
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[name].fields])
        day = F.to_date(F.coalesce(*[F.col(c) for c in TIMES[name]], F.localtimestamp()))
        rows.withColumn(DAY, day).write.mode("append").partitionBy(DAY).parquet(self.path(name))

    def drop_old(self, as_of, days: int = 90) -> dict[str, list[str]]:
        """Deletes the days that lie wholly before the retention window from disk, whole folders without
        reading a row, and returns them by table. A run's rows lie in the day of its start."""
        first = (_ts(as_of) - timedelta(days=days)).date().isoformat()
        gone = {}
        for name in TABLES:
            old = [d for d in folders(self.spark, self.path(name)) if d.startswith(f"{DAY}=") and d.split("=")[1] < first]
            for d in old:
                delete_folder(self.spark, f"{self.path(name)}/{d}")
            gone[name] = [d.split("=")[1] for d in old]
        return gone

    def _event(self, batch_id, source, table, status, start=None, end=None, read=None, written=None, message=None, watermark=None):
        """One state of a run. ``event_seq`` is the clock in microseconds, growing within a log, so a
        retry's start comes after the end it retries."""
        failed = (read - written) if (read is not None and written is not None) else None
        self._last_event = max(time.time_ns() // 1000, self._last_event + 1)
        row = (batch_id, source, table, self._last_event, _ts(start), _ts(end), status, read, written, failed, message, _ts(watermark),
               PIPELINE_VERSION, self.spark.version, self.cluster_id)
        self.append("audit_batch_runs", one_row(self.spark, row, RUN_EVENT_SCHEMA))

    def log_batch_start(self, batch_id: str, source: str, table: str, at) -> None:
        """L1: RUNNING."""
        self._event(batch_id, source, table, RUNNING, start=at)

    def log_batch_success(self, batch_id, source, table, read: int, written: int, at, watermark=None, start=None) -> None:
        """L2: SUCCESS with counts and the high-water mark of the committed rows."""
        self._event(batch_id, source, table, SUCCESS, start=start, end=at, read=read, written=written, watermark=watermark)

    def log_batch_failure(self, batch_id, source, table, message: str, at, start=None) -> None:
        """L3: FAILED with the error text (the caller re-raises)."""
        self._event(batch_id, source, table, FAILED, start=start, end=at, message=message)

    def log_quality(self, metrics: DataFrame) -> None:
        """L4: rule metrics rows from ``quality.rule_metrics``."""
        self.append("audit_data_quality", metrics)

    def log_data_quality_check(self, batch_id, source, table, rule_name, check_type, checked: int, passed: int,
                               column=None, severity="error", at=None) -> None:
        """L4 for counts measured elsewhere: failed = checked - passed, percentage 0 when nothing was checked."""
        failed = checked - passed
        pct = failed * 100.0 / checked if checked > 0 else 0.0
        sev = severity.lower()
        row = (f"dq_{batch_id}_{rule_name}", batch_id, source, table, _ts(at), rule_name, column, check_type.upper(),
               checked, passed, failed, pct, sev, sev == "error" and failed > 0)
        self.append("audit_data_quality", one_row(self.spark, row, QUALITY_SCHEMA))

    def log_rule_counts(self, batch_id, source, table, per_rule, at=None) -> None:
        """L4 for counts observed on a write (``quality.observed_metrics``): one append for all rules."""
        rows = [
            (f"dq_{batch_id}_{name}", batch_id, source, table, _ts(at), name, col, ctype, checked, passed, failed, pct, sev, quar)
            for name, col, ctype, checked, passed, failed, pct, sev, quar in per_rule
        ]
        if rows:
            self.append("audit_data_quality", rows_frame(self.spark, rows, QUALITY_SCHEMA))

    def log_schema_changes(self, changes: DataFrame) -> None:
        """L5."""
        self.append("audit_schema_evolution", changes)

    def log_lineage(self, rows: DataFrame) -> None:
        """L7."""
        self.append("audit_lineage", rows)

    def log_load_lineage(self, batch_id, source, steps, at) -> None:
        """L7 of one load: ``steps`` are (source table, target table, operation, records in, records out, how);
        one append for all of them. A target is named by layer, so its schema is the part before the first ``_``."""
        rows = [
            (f"lineage_{batch_id}_{target}", batch_id, source, origin, None, target.split("_")[0], target, operation, _ts(at), n_in, n_out, how)
            for origin, target, operation, n_in, n_out, how in steps
        ]
        self.append("audit_lineage", rows_frame(self.spark, rows, LINEAGE_SCHEMA))

    def runs(self) -> DataFrame:
        return latest_state(self.table("audit_batch_runs"))


def latest_checks(rows: DataFrame) -> DataFrame:
    """One row per check of a batch and table: a retried batch logs its checks again, the last counts."""
    keys = ["check_id", "source_name", "table_name"]
    rest = [c for c in rows.columns if c not in (*keys, "check_timestamp")]
    last = rows.groupBy(*keys).agg(F.max(F.struct("check_timestamp", *rest)).alias("_last"))
    return last.select(*keys, "_last.*").select(*rows.columns)


def latest_state(events: DataFrame) -> DataFrame:
    """One row per run with its latest state; start time from the first event.

    records_failed = read - written; execution_duration_ms = end - start in ms.
    """
    payload = [c for c in events.columns if c not in RUN_KEY and c not in ("event_seq", "records_failed")]
    last = F.max(F.struct("event_seq", *payload)).alias("_last")
    runs = events.groupBy(*RUN_KEY).agg(last, F.min("run_start_time").alias("_start"))
    cols = [F.col(c) for c in RUN_KEY]
    for c in payload:
        if c == "run_start_time":
            cols.append(F.coalesce(F.col("_last.run_start_time"), F.col("_start")).alias(c))
        else:
            cols.append(F.col(f"_last.{c}").alias(c))
    out = runs.select(*cols)
    return out.withColumns(
        {
            "records_failed": F.col("records_read") - F.col("records_written"),
            "execution_duration_ms": F.floor(
                F.timestamp_diff("MICROSECOND", F.col("run_start_time"), F.col("run_end_time")) / 1000
            ).cast("bigint"),
        }
    )


def _since(col: str, as_of, **interval):
    """Rows in the look-back window that ends at ``as_of`` (inclusive at both ends)."""
    ts = F.lit(as_of).cast("timestamp_ntz")
    days, hours = interval.get("days", 0), interval.get("hours", 0)
    return F.col(col).between(ts - F.make_dt_interval(F.lit(days), F.lit(hours)), ts)


def batch_history(runs: DataFrame, source: str | None = None, table: str | None = None, limit: int = 100) -> DataFrame:
    """Newest runs first, optional filters; a top-k (TakeOrderedAndProject)."""
    out = runs
    if source:
        out = out.where(F.col("source_name") == source)
    if table:
        out = out.where(F.col("table_name") == table)
    return out.orderBy(F.col("run_start_time").desc()).limit(limit)


def failed_batches(runs: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Failed runs started in the last ``hours``, newest first."""
    return (
        runs.where((F.col("status") == FAILED) & _since("run_start_time", as_of, hours=hours))
        .select("batch_id", "source_name", "table_name", "run_start_time", "run_end_time", "error_message", "execution_duration_ms")
        .orderBy(F.col("run_start_time").desc())
    )


def pipeline_metrics(runs: DataFrame, as_of, days: int = 30) -> DataFrame:
    """A5: one row of totals over the last ``days``; success_rate is 0 without runs."""
    recent = runs.where(_since("run_start_time", as_of, days=days))
    agg = recent.agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.count_if(F.col("status") == SUCCESS).alias("successful_batches"),
        F.count_if(F.col("status") == FAILED).alias("failed_batches"),
        F.sum("records_read").alias("total_records_read"),
        F.sum("records_written").alias("total_records_written"),
        F.avg("execution_duration_ms").alias("avg_duration_ms"),
    )
    rate = F.when(F.col("total_batches") > 0, F.col("successful_batches") * 100.0 / F.col("total_batches")).otherwise(F.lit(0.0))
    return agg.withColumn("success_rate", rate)


def dq_summary(quality_rows: DataFrame, as_of, source: str | None = None, days: int = 7) -> DataFrame:
    """A4: per source, table and rule over the last ``days``."""
    q = quality_rows.where(_since("check_timestamp", as_of, days=days))
    if source:
        q = q.where(F.col("source_name") == source)
    return q.groupBy("source_name", "table_name", "rule_name").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.sum("records_checked").alias("total_records_checked"),
        F.sum("records_failed").alias("total_records_failed"),
        exact_mean("failure_percentage").alias("avg_failure_percentage"),
        F.count_if(F.col("severity") == "error").alias("error_count"),
        F.count_if(F.col("severity") == "warn").alias("warn_count"),
    )


def dq_failure_rate(quality_rows: DataFrame) -> DataFrame:
    """Average failure percentage per source, table and rule."""
    return quality_rows.groupBy("source_name", "table_name", "rule_name").agg(
        exact_mean("failure_percentage").alias("avg_failure_rate")
    )


def retain(events: DataFrame, as_of, days: int = 90) -> DataFrame:
    """All states of the runs that started inside the retention window or later; writing them as a
    new snapshot drops the rest. Later states need no start time of their own, and runs newer than
    ``as_of`` stay."""
    started = events.groupBy(*RUN_KEY).agg(F.min("run_start_time").alias("_started"))
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    gone = started.where(F.col("_started") < cutoff).select(*RUN_KEY)
    return events.join(gone, list(RUN_KEY), "left_anti").select(*events.columns)


def high_water_mark(runs: DataFrame, source: str, table: str) -> DataFrame:
    """One row, the largest watermark of successful runs (epoch when none)."""
    ok = runs.where(
        (F.col("source_name") == source) & (F.col("table_name") == table) & (F.col("status") == SUCCESS) & F.col("watermark_value").isNotNull()
    )
    return ok.agg(F.coalesce(F.max("watermark_value"), F.lit(EPOCH).cast("timestamp_ntz")).alias("watermark"))

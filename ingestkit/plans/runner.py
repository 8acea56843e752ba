"""Run configured tables through bronze -> quality -> silver -> gold, with audit rows.

A plain loop over tables on the driver; each step is Spark work, and each
written table costs one action. Counts and the high-water mark come from
``observe`` on the bronze write itself, so the source is read once.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import drift, enrich, evolution, quality, scd
from ..operators.unique import KnownKeys
from ..sources.route import read_source, register_views
from ..spec import ResolvedTable, Rule
from ..store import BatchPartitionedTable, HistoryTable, KeyedTable, Layout, _put, read_table, write_bronze, write_gold, write_quarantine
from ..streaming.ingest import run_available_now


#: Number of a landed row within its batch (tables with a unique key), and why its key is a duplicate.
ROW, DUPLICATE = "_row_number", "_duplicate_key"


@dataclass
class LoadResult:
    table: ResolvedTable
    bronze_path: str
    silver: DataFrame
    rows_read: int
    rows_quarantined: int
    watermark: object


def bronze_name(t: ResolvedTable) -> str:
    return f"bronze_{t.source.name}_{t.table.name}"


def silver_name(t: ResolvedTable) -> str:
    return f"silver_{t.source.name}_{t.table.name}"


def load_table(
    spark: SparkSession,
    table: ResolvedTable,
    source_df: DataFrame,
    rules,
    batch_id: str,
    run_ts: str,
    root: str,
    log: A.AuditLog,
) -> LoadResult:
    """Layout merged with the stored one, its changes logged (L5) -> bronze write (K1) with observed counts
    (A8) -> unique keys (Q8) -> rule metrics (L4) and quarantine (K2) -> SCD apply into silver (K3) -> lineage
    rows (L7) and audit success (L2). Failures are logged (L3) and re-raised.
    The run starts at ``run_ts`` and ends as much later as the load took."""
    spec = table.table
    began = time.monotonic()

    def now() -> datetime:
        return datetime.fromisoformat(str(run_ts)) + timedelta(seconds=time.monotonic() - began)

    log.log_batch_start(batch_id, table.source.name, spec.name, run_ts)
    try:
        bronze = enrich.add_audit_columns(source_df, table, batch_id, run_ts)
        obs = Observation(f"{bronze_name(table)}_{batch_id}")
        metrics = [F.count(F.lit(1)).alias("rows")]
        if spec.incremental_column:
            metrics.append(F.max(spec.incremental_column).alias("watermark"))
        bronze_path = f"{root}/{bronze_name(table)}"
        if spec.unique_key:
            bronze = bronze.withColumn(ROW, F.monotonically_increasing_id())
        stored, before, _ = Layout(spark, bronze_path).grown(bronze.schema, batch_id)
        if before is not None and before.simpleString() != bronze.schema.simpleString():
            changes = drift.schema_diff(spark, before, bronze.schema)
            log.log_schema_changes(
                drift.schema_change_rows(changes, batch_id, table.source.name, spec.name, before, bronze.schema, run_ts)
            )
        write_bronze(evolution.conform(bronze.observe(obs, *metrics), stored), bronze_path)
        seen = obs.get
        rows = int(seen.get("rows", 0))
        landed = read_table(spark, bronze_path).where(F.col("_batch_id") == batch_id)
        columns = [c for c in landed.columns if c != ROW]
        rules = list(rules) + quality.unique_key_rules(spec.primary_key)
        if spec.unique_key:
            keys = KnownKeys(spark, f"{root}/{bronze_name(table)}_keys", spec.primary_key, spec.buckets)
            landed = with_duplicates(spark, landed, keys, batch_id, f"{root}/{bronze_name(table)}_duplicates", spec.sequence_by)
            rules.append(Rule(f"unique_primary_key__{'_'.join(spec.primary_key)}", f"{DUPLICATE} IS NULL", "error", spec.primary_key, "UNIQUE"))
        # One pass over the landed batch writes the quarantine and counts every rule.
        marked, counter, expanded = quality.observe_rules(landed, rules, f"{bronze_name(table)}_{batch_id}_rules")
        write_quarantine(quality.quarantine(marked, rules, batch_id, run_ts, columns=columns), f"{root}/{bronze_name(table)}_quarantine")
        _, n_bad, per_rule = quality.observed_metrics(counter, expanded)
        log.log_rule_counts(batch_id, table.source.name, spec.name, per_rule, run_ts)
        good = quality.drop_failing(landed, rules).select(*columns)
        path, order = f"{root}/{silver_name(table)}", list(spec.sequence_by) or ["_ingestion_timestamp"]
        if spec.scd_type == "SCD2":
            silver = HistoryTable(spark, path, spec.primary_key, spec.scd_columns or None, order, spec.buckets).load(good, batch_id)
        elif spec.scd_type in ("APPEND", "SCD0"):
            store = BatchPartitionedTable(spark, path)
            new = scd.new_rows(store.read_without(batch_id), good, spec)
            silver = store.add(enrich.add_scd_columns(new, batch_id, run_ts), batch_id)
        else:

            def change(target: DataFrame | None, batch: DataFrame) -> DataFrame:
                if spec.scd_type != "UPSERT":
                    return scd.apply_scd(target, batch, spec, batch_id)
                target = None if target is None else target.drop("_scd_action")
                return scd.action_label(scd.apply_scd(target, batch, spec, batch_id), spec.primary_key)

            silver = KeyedTable(spark, path, spec.primary_key, spec.buckets).apply(good, batch_id, change)
        if spec.unique_key:
            keys.add(good, batch_id)
        log.log_load_lineage(
            batch_id,
            table.source.name,
            [(spec.origin, bronze_name(table), spec.load_type.upper(), rows, rows, "audit columns"),
             (bronze_name(table), silver_name(table), spec.scd_type, rows, rows - n_bad, "; ".join(r.name for r in rules))],
            now(),
        )
        log.log_batch_success(batch_id, table.source.name, spec.name, read=rows, written=rows - n_bad, at=now(),
                              watermark=seen.get("watermark"), start=run_ts)
        return LoadResult(table, bronze_path, silver, rows, n_bad, seen.get("watermark"))
    except Exception as e:
        log.log_batch_failure(batch_id, table.source.name, spec.name, str(e), at=now(), start=run_ts)
        raise


def with_duplicates(spark: SparkSession, landed: DataFrame, keys: KnownKeys, batch_id: str, path: str, order) -> DataFrame:
    """``landed`` with the reason why a row's key is a duplicate, or null. The rows are written once with their
    reasons, so counting, quarantine and silver agree on them and none of them joins again; ``path`` lists the
    duplicates by row number."""
    found = keys.marked(landed, batch_id, ROW, list(order), unordered=("_ingestion_timestamp",))
    found = found.withColumnRenamed("reason", DUPLICATE).withColumn("_batch", F.lit(batch_id))
    marked = f"{keys.root}/marked"
    _put(found, marked, "_batch")
    rows = spark.read.schema(found.schema).parquet(marked).where(F.col("_batch") == batch_id)
    _put(rows.where(F.col(DUPLICATE).isNotNull()).select(ROW, F.col(DUPLICATE).alias("reason"), "_batch"), path, "_batch")
    return rows.drop("_batch")


def stored_watermark(table: ResolvedTable, log: A.AuditLog) -> datetime | None:
    """The largest watermark of the table's successful runs; None before the first."""
    mark = A.high_water_mark(log.runs(), table.source.name, table.table.name).first()["watermark"]
    return None if mark == datetime.fromisoformat(A.EPOCH) else mark


def silver_table(spark: SparkSession, table: ResolvedTable, root: str) -> DataFrame | None:
    """The stored silver table, or None before its first load."""
    path = f"{root}/{silver_name(table)}"
    if table.table.scd_type == "SCD2":
        return HistoryTable(spark, path, table.table.primary_key).read()
    if table.table.scd_type in ("APPEND", "SCD0"):
        return BatchPartitionedTable(spark, path).read()
    return KeyedTable(spark, path, table.table.primary_key).read()


def run_tables(
    spark: SparkSession,
    tables: list[ResolvedTable],
    batch_id: str,
    run_ts: str,
    root: str,
    log: A.AuditLog,
    rules: dict[str, list] | None = None,
    schemas: dict | None = None,
    gold: dict[str, Callable[[SparkSession], DataFrame]] | None = None,
) -> dict[str, DataFrame]:
    """Load every configured table, register its silver views, then write the gold tables (K6).

    Each table is read by its source type from its stored watermark on. A stream is read as far as it
    goes, every micro-batch loaded under an id of its own, so a replayed one is applied once. ``rules``
    and ``schemas`` are keyed by table name; a ``gold`` function builds its table from the silver views.
    A failing table is logged and the others still load; gold is then left as it is and an error raised.
    """
    failed = []
    for table in tables:
        spec, checks = table.table, (rules or {}).get(table.table.name, [])
        try:
            mark = stored_watermark(table, log) if spec.incremental_column else None
            source = read_source(spark, table, mark, (schemas or {}).get(spec.name))
            if source.isStreaming:
                name = bronze_name(table)

                def sink(batch: DataFrame, epoch: int, table=table, checks=checks, name=name) -> None:
                    load_table(batch.sparkSession, table, batch, checks, f"{name}_{epoch}", run_ts, root, log)

                run_available_now(source, f"{root}/_checkpoints/{name}", sink, name)
            else:
                load_table(spark, table, source, checks, batch_id, run_ts, root, log)
        except Exception as e:  # noqa: BLE001 - raised below, after the other tables
            failed.append((table, e))
            continue
        silver = silver_table(spark, table, root)
        if silver is not None and spec.scd_type == "SCD2":
            register_views(silver, silver_name(table))
        elif silver is not None:
            silver.createOrReplaceTempView(silver_name(table))
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(tables)} tables failed: " + ", ".join(silver_name(t) for t, _ in failed)) from failed[0][1]
    return {name: write_gold(build(spark), f"{root}/gold_{name}") for name, build in (gold or {}).items()}

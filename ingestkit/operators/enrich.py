"""Row enrichment: audit columns (E1), SCD metadata (E2), tracked columns (E6), record JSON."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import ts_literal
from ..spec import PIPELINE_VERSION, ResolvedTable

# Names of the bronze audit columns and the SCD metadata columns.
AUDIT_COLUMNS = (
    "_ingestion_timestamp",
    "_batch_id",
    "_source_system",
    "_source_table",
    "_load_type",
    "_pipeline_version",
)
SCD_COLUMNS = (
    "_scd_batch_id",
    "_scd_ingestion_timestamp",
    "_scd_effective_date",
    "_scd_end_date",
    "_scd_is_current",
)


def _ts(run_ts: str | datetime | Column | None) -> Column:
    if run_ts is None:
        return F.localtimestamp()
    if isinstance(run_ts, Column):
        return run_ts
    return ts_literal(run_ts)


def add_audit_columns(df: DataFrame, table: ResolvedTable, batch_id: str, run_ts=None) -> DataFrame:
    """Stamp every row with the load's identity in one projection."""
    return df.withColumns(
        {
            "_ingestion_timestamp": _ts(run_ts),
            "_batch_id": F.lit(batch_id),
            "_source_system": F.lit(table.source.name),
            "_source_table": F.lit(table.table.origin),
            "_load_type": F.lit(table.table.load_type),
            "_pipeline_version": F.lit(PIPELINE_VERSION),
        }
    )


def add_scd_columns(df: DataFrame, batch_id: str, run_ts=None, effective: str | None = None) -> DataFrame:
    """Open-version metadata; the effective date comes from ``effective`` when given."""
    ts = _ts(run_ts)
    return df.withColumns(
        {
            "_scd_batch_id": F.lit(batch_id),
            "_scd_ingestion_timestamp": ts,
            "_scd_effective_date": F.col(effective).cast("timestamp_ntz") if effective else ts,
            "_scd_end_date": F.lit(None).cast("timestamp_ntz"),
            "_scd_is_current": F.lit(True),
        }
    )


def tracked_columns(df: DataFrame, keys, exclude=()) -> list[str]:
    """Every column except the keys, the excluded ones and ``_``-prefixed metadata."""
    skip = set(keys) | set(exclude)
    return [c for c in df.columns if c not in skip and not c.startswith("_")]


def record_json(df: DataFrame, columns=None) -> Column:
    """The row (or the listed columns) as one JSON string."""
    cols = columns or [c for c in df.columns if not c.startswith("_") or c == "_corrupt_record"]
    return F.to_json(F.struct(*[F.col(c) for c in cols]))

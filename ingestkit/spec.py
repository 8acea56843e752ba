"""Typed configuration: sources, tables and quality rules.

The effective table configuration is the source settings with the table's own
settings on top; ``resolve`` builds it without merging dictionaries.
"""

from __future__ import annotations

import secrets
from dataclasses import dataclass, field, replace
from datetime import datetime

# Accepted source types, load types and SCD patterns.
SOURCE_TYPES = ("jdbc", "kafka", "cloud_storage", "file", "api")
LOAD_TYPES = ("full", "incremental", "streaming")
SCD_TYPES = ("SCD0", "SCD1", "SCD2", "SCD3", "UPSERT", "APPEND")
SEVERITIES = ("error", "warn")
CHECK_TYPES = ("NOT_NULL", "RANGE", "REGEX", "UNIQUE", "CUSTOM")
PIPELINE_VERSION = "1.0.0"


@dataclass(frozen=True)
class SourceSpec:
    name: str
    type: str
    connection: dict = field(default_factory=dict)
    credentials: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.name:
            raise ValueError("source needs a name")
        if self.type not in SOURCE_TYPES:
            raise ValueError(f"unknown source type {self.type!r}; expected one of {SOURCE_TYPES}")


@dataclass(frozen=True)
class TableSpec:
    name: str
    source_table: str | None = None
    source_object: str | None = None
    topic: str | None = None
    path: str | None = None
    primary_key: tuple[str, ...] = ("id",)
    incremental_column: str | None = None
    load_type: str = "full"
    watermark_seconds: int = 0
    scd_type: str = "APPEND"
    scd_columns: tuple[str, ...] | None = None
    sequence_by: tuple[str, ...] = ()
    format: str | None = None
    options: dict = field(default_factory=dict)
    file_pattern: str | None = None
    #: Rows whose key an earlier load, or row of the load, has brought go to quarantine.
    unique_key: bool = False
    #: Hash buckets of a keyed silver table, fixed with its first batch (see ``store.BUCKETS``).
    buckets: int = 16

    def __post_init__(self):
        pk = (self.primary_key,) if isinstance(self.primary_key, str) else tuple(self.primary_key)
        object.__setattr__(self, "primary_key", pk)
        object.__setattr__(self, "scd_type", (self.scd_type or "APPEND").upper())
        if isinstance(self.sequence_by, str):
            object.__setattr__(self, "sequence_by", (self.sequence_by,))
        if self.load_type not in LOAD_TYPES:
            raise ValueError(f"unknown load type {self.load_type!r}")
        if self.scd_type not in SCD_TYPES:
            raise ValueError(f"unknown SCD type {self.scd_type!r}")
        if self.watermark_seconds < 0:
            raise ValueError("watermark_seconds must be >= 0")

    @property
    def origin(self) -> str:
        """Name of the object read at the source ('' when none is set)."""
        return self.source_table or self.source_object or self.topic or ""


@dataclass(frozen=True)
class ResolvedTable:
    """A table entry together with the source that serves it."""

    source: SourceSpec
    table: TableSpec

    def with_table(self, **changes) -> "ResolvedTable":
        return ResolvedTable(self.source, replace(self.table, **changes))


def resolve(source: SourceSpec, table: TableSpec) -> ResolvedTable:
    if table.load_type == "incremental" and source.type not in ("cloud_storage", "file") and not table.incremental_column:
        raise ValueError(f"table {table.name!r}: incremental load needs incremental_column")
    return ResolvedTable(source, table)


@dataclass(frozen=True)
class Rule:
    """A quality rule: a SQL boolean condition, optionally a ``{col}`` template."""

    name: str
    condition: str
    severity: str = "error"
    columns: tuple[str, ...] = ()
    check_type: str = "CUSTOM"

    def __post_init__(self):
        sev = self.severity.lower()
        if sev not in SEVERITIES:
            raise ValueError(f"rule {self.name!r}: severity must be one of {SEVERITIES}")
        object.__setattr__(self, "severity", sev)
        if isinstance(self.columns, str):
            object.__setattr__(self, "columns", (self.columns,))
        if self.check_type.upper() not in CHECK_TYPES:
            raise ValueError(f"rule {self.name!r}: unknown check type {self.check_type!r}")
        object.__setattr__(self, "check_type", self.check_type.upper())
        if "{col}" in self.condition and not self.columns:
            raise ValueError(f"rule {self.name!r}: template needs columns")


def new_batch_id(now: datetime | None = None) -> str:
    """``batch_YYYYmmdd_HHMMSS_<8 hex>``."""
    now = now or datetime.now()
    return f"batch_{now:%Y%m%d_%H%M%S}_{secrets.token_hex(4)}"

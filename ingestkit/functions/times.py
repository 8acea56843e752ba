"""Timestamp helpers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_literal(value: str | datetime) -> Column:
    """A TIMESTAMP_NTZ literal (the fixtures store timestamps without zone)."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def minus_seconds(c: Column, seconds: int) -> Column:
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))

"""Source probes (S21) and credential masking."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Option names whose values are secrets, and the mask.
SECRET_NAMES = ("password", "secret", "token", "jaas", "key", "credential")
MASK = "***"


def mask_options(options: dict) -> dict:
    """The option dict with secret values replaced."""
    return {k: (MASK if any(s in k.lower() for s in SECRET_NAMES) else v) for k, v in options.items()}


def mask_text(c: Column) -> Column:
    """S22 on a column: ``password=...`` style pairs and JAAS passwords are masked."""
    c = F.regexp_replace(c, r'(?i)(password|secret|token)(\s*[=:]\s*)("[^"]*"|[^\s;,&]+)', "$1$2" + MASK)
    return c


def probe(spark: SparkSession, readers: dict[str, Callable[[], DataFrame]], options: dict[str, dict] | None = None) -> DataFrame:
    """Per source: reachable, column count, whether it has a row, masked options.

    Each probe runs a real action (``limit(1)``), so a broken source reports
    false instead of a lazy plan passing. The result is one row per source.
    """
    rows = []
    for name, make in readers.items():
        opts = ", ".join(f"{k}={v}" for k, v in sorted(mask_options((options or {}).get(name, {})).items()))
        try:
            df = make()
            has_rows = len(df.limit(1).take(1)) > 0
            rows.append((name, True, len(df.columns), has_rows, None, opts))
        except Exception as e:  # noqa: BLE001 - the probe reports, it does not raise
            rows.append((name, False, None, None, re.sub(r"\s+", " ", str(e)), opts))
    return spark.createDataFrame(
        rows, "source_name string, reachable boolean, n_columns int, has_rows boolean, error string, options string"
    )

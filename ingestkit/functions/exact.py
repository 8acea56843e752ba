"""Exact money sums: add as decimal so the result does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are added exactly to six decimals, so amounts below a cent count.
MONEY = "decimal(28,6)"

# Fixed value: precision used to average ratios exactly.
RATIO = "decimal(38,10)"


def exact_mean(c: str | Column) -> Column:
    """Mean of a double column summed as decimal(38,10): the same answer in any row order."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(RATIO)).cast("double") / F.count(col)

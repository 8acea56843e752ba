"""Change fingerprint (E5) and null-safe change test.

The fingerprint joins the tracked values with a separator after escaping the
escape character and the separator, and marks NULL with a token that no escaped
value can produce. So (NULL, 'a') and ('a', NULL) differ, and so do ('ab', 'c')
and ('a', 'bc'), which a plain ``concat_ws`` would confuse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the fingerprint text format.
SEPARATOR = "|"
ESCAPE = "\\"
NULL_TOKEN = "\\N"


def _escaped(c: Column) -> Column:
    text = F.replace(c.cast("string"), F.lit(ESCAPE), F.lit(ESCAPE + ESCAPE))
    text = F.replace(text, F.lit(SEPARATOR), F.lit(ESCAPE + SEPARATOR))
    return F.coalesce(text, F.lit(NULL_TOKEN))


def fingerprint(cols: list[str]) -> Column:
    """md5 hex of the escaped, null-marked, separator-joined values."""
    return F.md5(F.concat_ws(SEPARATOR, *[_escaped(F.col(c)) for c in cols]))


def fingerprint_sql(cols: list[str]) -> str:
    """The same fingerprint as ANSI SQL text (used by oracles and docs)."""
    parts = [
        f"coalesce(replace(replace(cast({c} AS VARCHAR), '\\', '\\\\'), '|', '\\|'), '\\N')"
        for c in cols
    ]
    return "md5(" + " || '|' || ".join(parts) + ")"

"""Rule builders (Q5, Q9) and template expansion.

A template rule such as ``{col} IS NOT NULL`` is expanded once per column into
concrete rules named ``<rule>__<column>``; column names are back-quoted.
"""

from __future__ import annotations

from ..spec import Rule

# The shipped rule set of the configuration.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
DEFAULT_RULES = (
    ("not_null", "{col} IS NOT NULL", "error"),
    ("positive_value", "{col} > 0", "warn"),
    ("valid_email", "{col} RLIKE '" + EMAIL_PATTERN.replace("\\", "\\\\") + "'", "error"),
)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def not_null(column: str, severity: str = "error", name: str | None = None) -> Rule:
    return Rule(name or f"not_null__{column}", f"{quote(column)} IS NOT NULL", severity, (column,), "NOT_NULL")


def in_range(column: str, low=None, high=None, severity: str = "warn", name: str | None = None) -> Rule:
    parts = []
    if low is not None:
        parts.append(f"{quote(column)} >= {low!r}")
    if high is not None:
        parts.append(f"{quote(column)} <= {high!r}")
    if not parts:
        raise ValueError("range rule needs a bound")
    return Rule(name or f"range__{column}", " AND ".join(parts), severity, (column,), "RANGE")


def positive(column: str, severity: str = "warn", name: str | None = None) -> Rule:
    return Rule(name or f"positive_value__{column}", f"{quote(column)} > 0", severity, (column,), "RANGE")


def matches(column: str, pattern: str, severity: str = "error", name: str | None = None) -> Rule:
    escaped = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return Rule(name or f"regex__{column}", f"{quote(column)} RLIKE '{escaped}'", severity, (column,), "REGEX")


def valid_email(column: str, severity: str = "error", name: str | None = None) -> Rule:
    return matches(column, EMAIL_PATTERN, severity, name or f"valid_email__{column}")


def expand(rules) -> list[Rule]:
    """Replace ``{col}`` templates by one rule per listed column."""
    out: list[Rule] = []
    for r in rules:
        if "{col}" not in r.condition:
            out.append(r)
            continue
        for c in r.columns:
            out.append(Rule(f"{r.name}__{c}", r.condition.replace("{col}", quote(c)), r.severity, (c,), r.check_type))
    names = [r.name for r in out]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate rule names: {names}")
    return out


def default_rules(columns_by_rule: dict[str, list[str]]) -> list[Rule]:
    """The configured default rules, applied to the columns given per rule name."""
    out = []
    for name, cond, sev in DEFAULT_RULES:
        cols = tuple(columns_by_rule.get(name, ()))
        if cols:
            out.append(Rule(name, cond, sev, cols))
    return expand(out)

"""Data quality: rules, metrics, quarantine.

NULL semantics are kept apart on purpose: an error rule keeps a row only when
its condition is TRUE (NULL drops it and sends it to quarantine, so good +
quarantine = input), while a warn rule counts a row only when its condition is
FALSE (NULL is not counted).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import expand
from ..spec import Rule
from .enrich import _ts, record_json

FAILED = "_failed_rules"

# Fixed value: schema of quarantine rows.
QUARANTINE_COLUMNS = ("record_data", "failed_rules", "quarantine_timestamp", "batch_id")


def _cond(rule: Rule) -> Column:
    return F.expr(rule.condition)


def _holds(rule: Rule) -> Column:
    return F.coalesce(_cond(rule), F.lit(False))


def _error_rules(rules) -> list[Rule]:
    return [r for r in expand(rules) if r.severity == "error"]


def with_failed_rules(df: DataFrame, rules) -> DataFrame:
    """Q7: an array with the names of the error rules a row does not pass."""
    errs = _error_rules(rules)
    if not errs:
        return df.withColumn(FAILED, F.array().cast("array<string>"))
    names = F.array(*[F.when(~_holds(r), F.lit(r.name)) for r in errs])
    return df.withColumn(FAILED, F.array_compact(names))


def drop_failing(df: DataFrame, rules) -> DataFrame:
    """Keep rows on which every error rule is TRUE."""
    errs = _error_rules(rules)
    if not errs:
        return df
    # A WHERE already drops rows whose condition is NULL; leaving the bare
    # conditions lets simple rules reach the scan as pushed filters.
    return df.where(reduce(lambda a, b: a & b, [_cond(r) for r in errs]))


def quarantine(df: DataFrame, rules, batch_id: str, run_ts=None, columns=None) -> DataFrame:
    """K2 / Q7: failing rows as (record_data, failed_rules, quarantine_timestamp, batch_id)."""
    marked = with_failed_rules(df, rules)
    return marked.where(F.size(FAILED) > 0).select(
        record_json(df, columns).alias("record_data"),
        F.array_join(F.col(FAILED), ",").alias("failed_rules"),
        _ts(run_ts).alias("quarantine_timestamp"),
        F.lit(batch_id).alias("batch_id"),
    )


def split(df: DataFrame, rules, batch_id: str, run_ts=None) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantine rows from one marking projection."""
    return drop_failing(df, rules), quarantine(df, rules, batch_id, run_ts)


def enforce(df: DataFrame, rules) -> DataFrame:
    """Q2: fail the job on the first row that breaks an error rule (lazy, no extra scan)."""
    out = df
    for r in _error_rules(rules):
        out = out.where(F.when(_holds(r), F.lit(True)).otherwise(F.raise_error(F.lit(f"expectation {r.name} failed: {r.condition}"))))
    return out


def rule_metrics(df: DataFrame, rules, batch_id: str = "", source: str = "", table: str = "", run_ts=None) -> DataFrame:
    """Q1 / Q4 / Q6: one row per rule from a single aggregation pass.

    records_failed = records_checked - records_passed; failure_percentage is 0
    when nothing was checked.
    """
    rs = expand(rules)
    aggs = [F.count(F.lit(1)).alias("_checked")]
    for i, r in enumerate(rs):
        if r.severity == "error":
            aggs.append(F.count_if(_holds(r)).alias(f"_p{i}"))
        else:
            aggs.append(F.count_if(~_cond(r)).alias(f"_f{i}"))
    one = df.agg(*aggs)
    rows = []
    for i, r in enumerate(rs):
        if r.severity == "error":
            passed = F.col(f"_p{i}")
            failed = F.col("_checked") - passed
        else:
            failed = F.col(f"_f{i}")
            passed = F.col("_checked") - failed
        rows.append(
            F.struct(
                F.lit(r.name).alias("rule_name"),
                F.lit(",".join(r.columns) if r.columns else None).cast("string").alias("column_name"),
                F.lit(r.check_type).alias("check_type"),
                F.col("_checked").alias("records_checked"),
                passed.alias("records_passed"),
                failed.alias("records_failed"),
                F.when(F.col("_checked") > 0, failed * 100.0 / F.col("_checked")).otherwise(F.lit(0.0)).alias("failure_percentage"),
                F.lit(r.severity).alias("severity"),
                ((F.lit(r.severity) == "error") & (failed > 0)).alias("is_quarantined"),
            )
        )
    out = one.select(F.inline(F.array(*rows)))
    return out.select(
        F.concat(F.lit("dq_"), F.lit(batch_id), F.lit("_"), F.col("rule_name")).alias("check_id"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(source).alias("source_name"),
        F.lit(table).alias("table_name"),
        _ts(run_ts).alias("check_timestamp"),
        "rule_name",
        "column_name",
        "check_type",
        "records_checked",
        "records_passed",
        "records_failed",
        "failure_percentage",
        "severity",
        "is_quarantined",
    )


def observe_rules(df: DataFrame, rules, name: str):
    """Attach rule counters to ``df`` so the next action over it (e.g. the
    quarantine write) also counts rows, quarantined rows and passes per rule.
    Returns (observed frame, Observation, expanded rules); read the counts with
    ``observed_metrics`` after that action."""
    from pyspark.sql import Observation

    rs = expand(rules)
    errs = [r for r in rs if r.severity == "error"]
    ok_all = reduce(lambda a, b: a & b, [_holds(r) for r in errs], F.lit(True))
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(~ok_all).alias("quarantined")]
    for i, r in enumerate(rs):
        passed = _holds(r) if r.severity == "error" else ~F.coalesce(~_cond(r), F.lit(False))
        metrics.append(F.count_if(passed).alias(f"passed_{i}"))
    obs = Observation(name)
    return df.observe(obs, *metrics), obs, rs


def observed_metrics(obs, rs) -> tuple[int, int, list[tuple]]:
    """(rows, quarantined, one tuple per rule: name, column, check type, checked,
    passed, failed, failure %, severity, is_quarantined) from an ``observe_rules`` counter."""
    m = obs.get
    rows, bad = int(m.get("rows", 0)), int(m.get("quarantined", 0))
    out = []
    for i, r in enumerate(rs):
        passed = int(m.get(f"passed_{i}", 0))
        failed = rows - passed
        pct = failed * 100.0 / rows if rows > 0 else 0.0
        out.append((r.name, ",".join(r.columns) or None, r.check_type, rows, passed, failed, pct, r.severity,
                    r.severity == "error" and failed > 0))
    return rows, bad, out


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Q8: keys that occur more than once, with their count (partial aggregation first)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unique_key_rules(keys) -> list[Rule]:
    """Q8 as row rules: the key is present (uniqueness is checked by ``duplicate_keys``)."""
    return [Rule(f"valid_primary_key__{k}", f"`{k}` IS NOT NULL", "error", (k,), "NOT_NULL") for k in keys]


def scd2_checks(history: DataFrame, keys, order=("_scd_effective_date",)) -> DataFrame:
    """Q10: one row of counts that must all be zero on a valid SCD2 table.

    null_effective: versions without an effective date; multi_current_keys:
    keys with more than one open version; overlaps: versions that start before
    the previous version of the key has ended (or while it is still open).
    """
    from .sequence import with_neighbors

    keys = list(keys)
    tie = [c for c in history.columns if c not in keys and c not in order and not c.startswith("_")]
    # Zero-length versions sort before the version that starts at the same time.
    ends = history.withColumn("_end_key", F.coalesce(F.col("_scd_end_date"), F.lit("9999-12-31").cast("timestamp_ntz")))
    nb = with_neighbors(ends, keys, list(order) + ["_end_key"] + tie, prev_cols=["_scd_end_date", "_scd_effective_date"])
    overlap = (~F.col("_is_first")) & (
        F.col("_prev__scd_end_date").isNull() | (F.col("_prev__scd_end_date") > F.col("_scd_effective_date"))
    )
    per_key = nb.groupBy(*keys).agg(
        F.count_if(F.col("_scd_effective_date").isNull()).alias("_null"),
        F.count_if(F.col("_scd_is_current")).alias("_cur"),
        F.count_if(overlap).alias("_ovl"),
    )
    return per_key.agg(
        F.coalesce(F.sum("_null"), F.lit(0)).cast("bigint").alias("null_effective"),
        F.count_if(F.col("_cur") > 1).alias("multi_current_keys"),
        F.coalesce(F.sum("_ovl"), F.lit(0)).cast("bigint").alias("overlaps"),
    )

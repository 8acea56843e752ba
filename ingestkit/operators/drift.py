"""Schema drift: column-level diff of two schemas (L5) and JSON key drift over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Change labels of the schema-evolution table.
ADD, DROP, TYPE_CHANGE = "ADD_COLUMN", "DROP_COLUMN", "TYPE_CHANGE"


def schema_diff(spark: SparkSession, previous: StructType, new: StructType) -> DataFrame:
    """One row per added, dropped or re-typed column (full outer join on the name)."""
    cols = "column_name string, type string"
    before = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in previous.fields], cols).alias("p")
    after = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in new.fields], cols).alias("n")
    joined = before.join(after, F.col("p.column_name") == F.col("n.column_name"), "full_outer")
    kind = (
        F.when(F.col("p.column_name").isNull(), F.lit(ADD))
        .when(F.col("n.column_name").isNull(), F.lit(DROP))
        .when(F.col("p.type") != F.col("n.type"), F.lit(TYPE_CHANGE))
    )
    return joined.select(
        kind.alias("change_type"),
        F.coalesce(F.col("n.column_name"), F.col("p.column_name")).alias("column_name"),
        F.col("p.type").alias("previous_type"),
        F.col("n.type").alias("new_type"),
    ).where(F.col("change_type").isNotNull())


def schema_change_rows(diff: DataFrame, batch_id: str, source: str, table: str, previous: StructType, new: StructType, run_ts) -> DataFrame:
    """L5 as audit rows for ``AuditLog.log_schema_changes``."""
    return diff.select(
        F.concat_ws("_", F.lit("evol"), F.lit(batch_id), F.col("column_name")).alias("evolution_id"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(source).alias("source_name"),
        F.lit(table).alias("table_name"),
        F.lit(run_ts).cast("timestamp_ntz").alias("change_timestamp"),
        F.lit(previous.simpleString()).alias("previous_schema"),
        F.lit(new.simpleString()).alias("new_schema"),
        "change_type",
        "column_name",
        "previous_type",
        "new_type",
    )


def json_key_drift(df: DataFrame, json_col: str, time_col: str, unit: str = "day") -> DataFrame:
    """Keys seen in a JSON text column per period, with the period each key first appeared.

    Keys are counted per (period, key) with map-side partial aggregation; the
    first-seen period is a second aggregation over that small result.
    """
    period = F.date_trunc(unit, F.col(time_col)).cast("timestamp_ntz").alias("period")
    keyed = df.select(period, F.explode(F.json_object_keys(F.col(json_col))).alias("json_key"))
    counts = keyed.groupBy("period", "json_key").agg(F.count(F.lit(1)).alias("n_rows"))
    first = counts.groupBy("json_key").agg(F.min("period").alias("first_seen"))
    return counts.join(first, "json_key").withColumn("is_new_key", F.col("period") == F.col("first_seen"))


def _paths(schema: str) -> dict[str, str]:
    """Path and type of every part of a VARIANT schema text: ``$.b.x`` of objects, ``$.b[]`` of array elements.
    A decimal is a decimal whatever its digits."""
    out: dict[str, str] = {}
    at = 0

    def name() -> str:
        nonlocal at
        if schema[at] != "`":
            end = schema.index(":", at)
            found, at = schema[at:end], end
            return found
        parts, at = [], at + 1
        while schema[at] != "`" or schema[at : at + 2] == "``":
            step = 2 if schema[at] == "`" else 1
            parts.append(schema[at])
            at += step
        at += 1
        return "".join(parts)

    def kind(path: str) -> None:
        nonlocal at
        word = at
        while at < len(schema) and schema[at] not in "<>,(":
            at += 1
        out[path] = word = schema[word:at]
        if at < len(schema) and schema[at] == "(":
            at = schema.index(")", at) + 1
        if at < len(schema) and schema[at] == "<":
            at += 1
            if word == "ARRAY":
                kind(f"{path}[]")
            else:
                while schema[at] != ">":
                    field = name()
                    at += 2  # colon and blank
                    kind(f"{path}.{field}")
                    at += 2 if schema[at] == "," else 0
            at += 1

    kind("$")
    return out


# Change labels of a path.
ADDED, DROPPED, RETYPED = "ADDED", "DROPPED", "RETYPED"


def json_path_drift(df: DataFrame, json_col: str, time_col: str, unit: str = "day") -> DataFrame:
    """L6 for nested data: paths that a period has and the one before it had not, the other way round, and
    paths whose type changed, as (period, previous_period, path, change, previous_type, new_type).

    The rows of a period are aggregated into one VARIANT schema (combined map-side), in which values of
    different types at one path are ``VARIANT``; a text that is no JSON, and a null, has no say. What reaches
    the driver is one schema text per period, whatever the number of rows.
    """
    spark = df.sparkSession
    period = F.date_trunc(unit, F.col(time_col)).cast("timestamp_ntz")
    parsed = df.select(period.alias("period"), F.try_parse_json(F.col(json_col)).alias("v")).where("v IS NOT NULL AND period IS NOT NULL")
    found = parsed.groupBy("period").agg(F.schema_of_variant_agg("v").alias("schema")).orderBy("period").collect()
    rows, before = [], None
    for r in found:
        now = _paths(r["schema"])
        if before is not None:
            old_period, old = before
            for path in sorted(old.keys() | now.keys()):
                a, b = old.get(path), now.get(path)
                if a != b:
                    change = ADDED if a is None else DROPPED if b is None else RETYPED
                    rows.append((r["period"], old_period, path, change, a, b))
        before = (r["period"], now)
    schema = "period timestamp_ntz, previous_period timestamp_ntz, path string, change string, previous_type string, new_type string"
    return spark.createDataFrame(rows, schema)

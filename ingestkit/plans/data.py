"""Inputs of the registered queries, derived from the driver's tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..spec import ResolvedTable, SourceSpec, TableSpec

# Fixed values used by the registered queries (and repeated in their oracles).
RUN_TS = "2024-01-31 00:00:00"
BATCH_ID = "batch_20240131_000000_0a1b2c3d"
CUTOFF = "1998-01-01"
SCD2_BATCHES = (("b1", (0, 1)), ("b2", (1, 2)), ("b3", (2, 3)))  # order keys modulo 4; neighbours overlap
AS_OF = "1997-06-30"
EVENTS_SPLIT = "2024-01-20"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer change log: one row per order, tracking status and priority."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("seq_key"),
    )


def scd2_batches(log: DataFrame) -> list[tuple[str, DataFrame]]:
    """The change log in batches by order key, each over all dates, so late rows and repeats occur."""
    part = F.coalesce(F.pmod(F.col("seq_key"), F.lit(4)), F.lit(0))
    return [(batch_id, log.where(part.isin(*parts))) for batch_id, parts in SCD2_BATCHES]


KEYS = ("customer_id",)
TRACKED = ("status", "priority")
ORDER = ("updated_at", "seq_key")


def between(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """Rows from ``lo`` to before ``hi``; rows without a time belong to the part that has no lower end."""
    c = F.col(column)
    if lo is not None:
        df = df.where(c >= F.lit(lo).cast("timestamp_ntz"))
    if hi is not None:
        before = c < F.lit(hi).cast("timestamp_ntz")
        df = df.where(before if lo is not None else before | c.isNull())
    return df


CRM = SourceSpec("crm_system", "cloud_storage", {"storage_type": "file"})
ORDERS_TABLE = ResolvedTable(
    CRM,
    TableSpec("orders", source_table="public.orders", primary_key=("o_orderkey",), incremental_column="o_orderdate", load_type="incremental"),
)
CUSTOMERS_TABLE = ResolvedTable(CRM, TableSpec("customers", source_table="public.customer", primary_key=("c_custkey",), scd_type="SCD2"))


AUDIT_AS_OF = "2024-01-31 00:00:00"


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log derived from events: every event is one load run with three state
    events (RUNNING, RUNNING with counts, then SUCCESS, or FAILED for 'error' events)."""
    ev = read(spark, sf_dir, "events")
    read_n = F.round(F.col("value") * 100).cast("bigint")
    written = F.greatest(read_n - F.col("user_id"), F.lit(0)).cast("bigint")
    end = F.timestamp_add("MILLISECOND", F.round(F.col("value") * 1000).cast("bigint"), F.col("ts"))
    failed = F.col("event_type") == "error"
    none_ts = F.lit(None).cast("timestamp_ntz")
    none_l = F.lit(None).cast("bigint")
    none_s = F.lit(None).cast("string")
    states = F.array(
        F.struct(F.lit(1).alias("event_seq"), F.col("ts").alias("run_start_time"), none_ts.alias("run_end_time"),
                 F.lit("RUNNING").alias("status"), none_l.alias("records_read"), none_l.alias("records_written"),
                 none_s.alias("error_message"), none_ts.alias("watermark_value")),
        F.struct(F.lit(2).alias("event_seq"), none_ts.alias("run_start_time"), none_ts.alias("run_end_time"),
                 F.lit("RUNNING").alias("status"), read_n.alias("records_read"), none_l.alias("records_written"),
                 none_s.alias("error_message"), none_ts.alias("watermark_value")),
        F.struct(F.lit(3).alias("event_seq"), none_ts.alias("run_start_time"), end.alias("run_end_time"),
                 F.when(failed, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
                 read_n.alias("records_read"), F.when(failed, F.lit(0).cast("bigint")).otherwise(written).alias("records_written"),
                 F.when(failed, F.concat(F.lit("error event "), F.col("event_id").cast("string"))).alias("error_message"),
                 F.when(~failed, F.col("ts")).alias("watermark_value")),
    )
    return ev.select(
        F.concat(F.lit("batch_"), F.col("event_id").cast("string")).alias("batch_id"),
        F.col("event_type").alias("source_name"),
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_name"),
        F.inline(states),
    )


def quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality log derived from the run log: two rule rows per run."""
    ev = read(spark, sf_dir, "events")
    checked = F.round(F.col("value") * 100).cast("bigint")
    err_failed = F.least(F.col("user_id"), checked).cast("bigint")
    warn_failed = F.least(F.col("event_id") % 5, checked).cast("bigint")
    at = F.timestamp_add("MILLISECOND", F.round(F.col("value") * 1000).cast("bigint"), F.col("ts"))

    def row(name, sev, failed):
        pct = F.when(checked > 0, failed.cast("double") * 100.0 / checked).otherwise(F.lit(0.0))
        return F.struct(F.lit(name).alias("rule_name"), F.lit(sev).alias("severity"), failed.alias("records_failed"), pct.alias("failure_percentage"))

    return ev.select(
        F.concat(F.lit("batch_"), F.col("event_id").cast("string")).alias("batch_id"),
        F.col("event_type").alias("source_name"),
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_name"),
        at.alias("check_timestamp"),
        checked.alias("records_checked"),
        F.inline(F.array(row("not_null__user_id", "error", err_failed), row("positive_value__value", "warn", warn_failed))),
    )


#: Loads of the schema and key queries, by order or line key modulo 3.
LOADS = (("b0", 0), ("b1", 1), ("b2", 2))


def load_part(df: DataFrame, key: str, i: int) -> DataFrame:
    """The rows of load ``i``; rows without a key are in the first."""
    return df.where(F.coalesce(F.pmod(F.col(key), F.lit(len(LOADS))), F.lit(0)) == i)


# The lineage edges of the orders and customer loads.
EDGES = (
    ("orders", "bronze_orders"),
    ("bronze_orders", "silver_orders"),
    ("silver_orders", "gold_daily_order_metrics"),
    ("silver_orders", "gold_customer_orders_summary"),
)
BIG_ORDER = 100000.0
DRIFT_FROM = "2024-01-15"


def yearly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per load (one per order year): rows read, and rows kept by the silver rule."""
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.concat(F.lit("batch_"), F.year("o_orderdate").cast("string")).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_source"),
        F.count_if(F.col("o_totalprice") >= BIG_ORDER).alias("n_silver"),
    )


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = yearly_counts(spark, sf_dir)
    n = {"orders": "n_source", "bronze_orders": "n_source", "silver_orders": "n_silver",
         "gold_daily_order_metrics": "n_silver", "gold_customer_orders_summary": "n_silver"}
    edges = F.array(*[
        F.struct(F.lit(s).alias("source_table"), F.lit(t).alias("target_table"),
                 F.col(n[s]).alias("source_record_count"), F.col(n[t]).alias("target_record_count"))
        for s, t in EDGES
    ])
    return counts.select("batch_id", F.inline(edges))


def drifting_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events whose props gain a key from the middle of the month on."""
    ev = read(spark, sf_dir, "events")
    grown = F.replace(F.col("props"), F.lit("}"), F.concat(F.lit(', "v2": '), F.col("user_id").cast("string"), F.lit("}")))
    return ev.withColumn("props", F.when(F.col("ts") >= F.lit(DRIFT_FROM).cast("timestamp_ntz"), grown).otherwise(F.col("props")))


def order_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lineage graph of the size of orders: every order is built from the one before it of its customer, by
    order key; for customers in a hundred the first is built from the last again, a cycle."""
    o = read(spark, sf_dir, "orders").where("o_custkey IS NOT NULL AND o_orderkey IS NOT NULL").select("o_custkey", "o_orderkey").distinct()
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    chain = o.withColumn("before", F.lag("o_orderkey").over(w))
    ends = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"), F.max("o_orderkey").alias("before"))
    edges = chain.where("before IS NOT NULL").unionByName(ends.where("o_custkey % 100 = 0"))
    name = lambda c: F.concat(F.lit("orders_"), F.col(c).cast("string"))
    return edges.select(name("before").alias("source_table"), name("o_orderkey").alias("target_table"))


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events whose props nest and drift by event time: a path comes, one goes, one changes its type, and an
    array's elements get a field; by the hour some rows are no JSON."""
    ev = read(spark, sf_dir, "events")

    def since(day):
        return F.col("ts") >= F.lit(day).cast("timestamp_ntz")

    text = F.col("user_id").cast("string")
    parts = F.concat(
        F.lit('{"user": {"id": '), F.when(since("2024-01-10"), F.concat(F.lit('"u'), text, F.lit('"'))).otherwise(text),
        F.when(since("2024-01-15"), F.lit(', "geo": {"zip": "z"}')).otherwise(F.lit("")),
        F.lit('}, "items": [{"n": 1'), F.when(since("2024-01-20"), F.lit(', "ok": true')).otherwise(F.lit("")), F.lit("}]"),
        F.when(since("2024-01-25"), F.lit("")).otherwise(F.lit(', "old": 1.5')), F.lit("}"),
    )
    return ev.withColumn("props", F.when(F.col("event_id") % 7 == 0, F.lit("no json")).otherwise(parts))

"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables whole (or data Spark derives from them)
and exercises one group of operators; ``oracle.py`` holds the matching SQL.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.fingerprint import fingerprint
from ..operators import enrich, gold, quality, scd
from ..session import scratch_path
from ..spec import Rule, SourceSpec, TableSpec, resolve
from ..store import HistoryTable
from . import data as D
from .data import KEYS, ORDER, TRACKED, read


# --- gold and the minimum slice -------------------------------------------------

def customers_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> audit columns -> drop rule (balance > 0) -> one row per key."""
    raw = read(spark, sf_dir, "customer")
    bronze = enrich.add_audit_columns(raw, D.CUSTOMERS_TABLE, D.BATCH_ID, D.RUN_TS)
    good = quality.drop_failing(bronze, [R.positive("c_acctbal", severity="error")])
    return scd.latest_per_key(good, ["c_custkey"], ["_ingestion_timestamp"])


def _customer_orders(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    customers = customers_silver(spark, sf_dir).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("mktsegment"),
    )
    orders = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_amount"),
        F.col("o_orderdate").alias("order_date"),
    )
    return gold.customer_order_summary(customers, orders, attributes=("customer_name", "mktsegment"))


def gold_customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of every customer over all orders."""
    return _customer_orders(spark, sf_dir, read(spark, sf_dir, "orders"))


gold_customer_orders_all = gold_customer_orders  # its key of the last round


def gold_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_amount"),
        F.col("o_orderdate").alias("order_date"),
    )
    return gold.daily_order_metrics(orders)


# --- enrichment -----------------------------------------------------------------

def enrich_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.add_audit_columns(read(spark, sf_dir, "orders"), D.ORDERS_TABLE, D.BATCH_ID, D.RUN_TS)


def fingerprint_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with NULLs and separator characters injected by rule."""
    c = read(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.replace(F.col("c_name"), F.lit("#"), F.lit("|")).alias("name"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        F.nullif(F.col("c_nationkey").cast("string"), F.lit("0")).alias("nation"),
    )


def change_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fingerprint_input(spark, sf_dir)
    tracked = enrich.tracked_columns(src, ["c_custkey"])
    return src.select("c_custkey", fingerprint(tracked).alias("_scd_hash"))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return scd.latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# --- quality --------------------------------------------------------------------

DQ_SETS = (
    ("customer", [R.not_null("c_name"), R.positive("c_acctbal"), R.in_range("c_nationkey", 0, 20, severity="error")]),
    ("part", [R.positive("p_retailprice"), R.in_range("p_size", 1, 40, severity="warn")]),
    ("lineitem", [R.in_range("l_discount", 0.0, 0.05, severity="error"), R.not_null("l_shipdate")]),
)
QUARANTINE_RULES = [R.positive("c_acctbal", severity="error"), R.in_range("c_nationkey", 0, 20, severity="error")]


def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for table, rs in DQ_SETS:
        m = quality.rule_metrics(read(spark, sf_dir, table), rs, D.BATCH_ID, "tpch", table, D.RUN_TS)
        out = m if out is None else out.unionByName(m)
    return out.drop("check_id", "batch_id", "check_timestamp")


def dq_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_failing(read(spark, sf_dir, "customer"), QUARANTINE_RULES)


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quarantine(read(spark, sf_dir, "customer"), QUARANTINE_RULES, D.BATCH_ID, D.RUN_TS)


def dq_email_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every e-mail-like token of each document with the rule's verdict; a document without one has a null."""
    found = F.regexp_extract_all("text", F.lit(r"(\S+@\S+)"), 1)
    docs = read(spark, sf_dir, "documents").select("doc_id", F.explode_outer(found).alias("email_candidate"))
    rule = R.valid_email("email_candidate")
    return docs.select("doc_id", "email_candidate", F.coalesce(F.expr(rule.condition), F.lit(False)).alias("is_valid_email"))


def dq_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [R.not_null("event_id"), R.not_null("ts"), Rule("known_type", "event_type IN ('signup','click','view','error','purchase')")]
    return quality.enforce(read(spark, sf_dir, "events"), rules)


# --- SCD ------------------------------------------------------------------------

def _initial_target(spark: SparkSession, sf_dir: str, scd_type: str) -> tuple[DataFrame, DataFrame]:
    log = D.customer_changes(spark, sf_dir)
    before = D.between(log, "updated_at", None, D.CUTOFF)
    after = D.between(log, "updated_at", D.CUTOFF, None)
    pick = scd.earliest_per_key if scd_type == "SCD0" else scd.latest_per_key
    target = pick(before, KEYS, ORDER).withColumns(
        {"_scd_type": F.lit(scd_type), "_scd_action": F.lit(scd.INSERT), "_scd_batch_id": F.lit("b0")}
    )
    return target, after


def scd0_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _initial_target(spark, sf_dir, "SCD0")
    return scd.scd0(target, batch, KEYS, ORDER, "b1").drop("_scd_type")


def scd1_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _initial_target(spark, sf_dir, "SCD1")
    return scd.scd1(target, batch, KEYS, TRACKED, ORDER, "b1").drop("_scd_type")


def upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _initial_target(spark, sf_dir, "UPSERT")
    return scd.upsert(target.drop("_scd_type", "_scd_action", "_scd_batch_id"), batch, KEYS, ORDER)


def append_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of events; the second re-reads one day back (look-back) and skips known ids."""
    ev = read(spark, sf_dir, "events")
    first = D.between(ev, "ts", None, D.EVENTS_SPLIT)
    overlap = ev.where(F.col("ts") >= F.lit(D.EVENTS_SPLIT).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY"))
    return scd.append(first, overlap, dedup_keys=["event_id"])


def scd2_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_history(D.customer_changes(spark, sf_dir), KEYS, TRACKED, ORDER)


def scd2_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log in three overlapping batches with late rows, each rebuilding the buckets of its keys."""
    log = D.customer_changes(spark, sf_dir)
    table = HistoryTable(spark, scratch_path(spark, "silver_customers_scd2"), KEYS, TRACKED, ORDER)
    for batch_id, batch in D.scd2_batches(log):
        history = table.load(batch, batch_id)
    return history.select(
        *log.columns, "_scd_batch_id", "_scd_effective_date", "_scd_end_date", "_scd_is_current", "_scd_hash", "_scd_action"
    )


def scd2_merge_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_merged(spark, sf_dir).drop("_scd_batch_id")


def scd2_current_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.current(scd2_history_query(spark, sf_dir))


def scd2_as_of_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.as_of(scd2_history_query(spark, sf_dir), D.AS_OF)


def scd2_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scd2_checks(scd2_merged(spark, sf_dir), KEYS)


def scd3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = D.customer_changes(spark, sf_dir)
    first = scd.scd3(None, D.between(log, "updated_at", None, D.CUTOFF), KEYS, TRACKED, ORDER, "b1")
    second = scd.scd3(first, D.between(log, "updated_at", D.CUTOFF, None), KEYS, TRACKED, ORDER, "b2")
    return second.drop("_scd_batch_id")


QUERIES = {
    "gold_customer_orders": gold_customer_orders,
    "gold_customer_orders_all": gold_customer_orders_all,
    "gold_daily_orders": gold_daily_orders,
    "enrich_audit_columns": enrich_audit_columns,
    "change_fingerprint": change_fingerprint,
    "dedup_latest": dedup_latest,
    "dq_metrics": dq_metrics,
    "dq_drop": dq_drop,
    "dq_quarantine": dq_quarantine,
    "dq_email_rule": dq_email_rule,
    "dq_unique_key": dq_unique_key,
    "dq_fail": dq_fail,
    "scd0": scd0_query,
    "scd1": scd1_query,
    "upsert": upsert_query,
    "append_dedup": append_dedup,
    "scd2_history": scd2_history_query,
    "scd2_merge": scd2_merge_query,
    "scd2_current": scd2_current_query,
    "scd2_as_of": scd2_as_of_query,
    "scd2_invariants": scd2_invariants,
    "scd3": scd3_query,
}


# --- audit ----------------------------------------------------------------------

from ..operators import audit as A  # noqa: E402


def audit_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.latest_state(D.run_events(spark, sf_dir))


def audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.batch_history(A.latest_state(D.run_events(spark, sf_dir)), source="click", limit=100)


def audit_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.failed_batches(A.latest_state(D.run_events(spark, sf_dir)), D.AUDIT_AS_OF, hours=24)


def audit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.pipeline_metrics(A.latest_state(D.run_events(spark, sf_dir)), D.AUDIT_AS_OF, days=30)


def audit_dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dq_summary(D.quality_rows(spark, sf_dir), D.AUDIT_AS_OF, days=7)


def audit_dq_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dq_failure_rate(D.quality_rows(spark, sf_dir))


def audit_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.retain(D.run_events(spark, sf_dir), D.AUDIT_AS_OF, days=10)


def watermark_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + F2: the first load commits its high-water mark; the next incremental read
    starts one day before it (strict >), so late rows inside the buffer are read again."""
    from ..sources.files import incremental_filter

    orders = read(spark, sf_dir, "orders")
    first = D.between(orders, "o_orderdate", None, D.CUTOFF)
    log = AuditLogFor(spark)
    log.ensure()
    wm = first.agg(F.max("o_orderdate").alias("wm")).first()["wm"]
    log.log_batch_success("b1", "crm_system", "orders", read=0, written=0, at=D.RUN_TS, watermark=wm)
    mark = A.high_water_mark(log.runs(), "crm_system", "orders").first()["watermark"]
    return incremental_filter(orders, "o_orderdate", mark, lookback_seconds=86400)


def AuditLogFor(spark: SparkSession) -> "A.AuditLog":
    return A.AuditLog(spark, scratch_path(spark, "audit"))


QUERIES.update(
    {
        "audit_latest_state": audit_latest_state,
        "audit_history": audit_history,
        "audit_failed": audit_failed,
        "audit_metrics": audit_metrics,
        "audit_dq_summary": audit_dq_summary,
        "audit_dq_rate": audit_dq_rate,
        "audit_retention": audit_retention,
        "watermark_lookback": watermark_lookback,
    }
)


# --- sources --------------------------------------------------------------------

from ..sources import files as S  # noqa: E402
from ..sources import kafka as K  # noqa: E402
from ..streaming import ingest as T  # noqa: E402


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def src_csv_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer landed as '|'-delimited CSV with a header, next to decoy JSON files."""
    cust = read(spark, sf_dir, "customer")
    land = scratch_path(spark, "landing_csv")
    cust.write.option("header", "true").option("delimiter", "|").csv(land)
    cust.write.mode("append").json(land)
    return S.read_files(spark, land, "csv", {"header": "true", "delimiter": "|"}, schema=_ddl(cust), file_pattern="*.csv")


def src_json_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part landed as JSON array files (one array spread over many lines per file)."""
    part = read(spark, sf_dir, "part")
    land = scratch_path(spark, "landing_json")
    S.write_json_arrays(part, land)
    return S.read_files(spark, land, "json", {"multiLine": "true"}, schema=_ddl(part))


def src_file_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as parquet mixed with decoy CSV files; only *.parquet is read."""
    orders = read(spark, sf_dir, "orders")
    land = scratch_path(spark, "landing_glob")
    orders.write.parquet(land)
    orders.write.mode("append").csv(land)
    return S.read_files(spark, land, "parquet", file_pattern="*.parquet")


EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def src_files_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in two drops, two availableNow runs on one checkpoint."""
    ev = read(spark, sf_dir, "events")
    land, out, ckpt = (scratch_path(spark, n) for n in ("landing_events", "bronze_events", "ckpt_events"))
    sink, _ = T.bronze_sink(out, name="events")
    D.between(ev, "ts", None, D.EVENTS_SPLIT).write.parquet(land)
    T.run_available_now(S.stream_files(spark, land, EVENT_SCHEMA), ckpt, sink, "events_drop_1")
    D.between(ev, "ts", D.EVENTS_SPLIT, None).write.mode("append").parquet(land)
    T.run_available_now(S.stream_files(spark, land, EVENT_SCHEMA), ckpt, sink, "events_drop_2")
    return T.read_bronze(spark, out).drop("_batch_id")


def src_kafka_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a Kafka topic dump (binary JSON values), parsed back with a schema."""
    ev = read(spark, sf_dir, "events")
    dump = scratch_path(spark, "topic_user_events")
    K.to_envelope(ev, "user_events", "event_id", "ts").write.parquet(dump)
    parsed = K.parse_json_envelope(spark.read.parquet(dump), EVENT_SCHEMA)
    return parsed.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))


# --- streaming ------------------------------------------------------------------

def scd2_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log arrives as three overlapping file drops with late rows; each micro-batch is merged."""
    log = D.customer_changes(spark, sf_dir)
    land, ckpt = scratch_path(spark, "landing_changes"), scratch_path(spark, "ckpt_changes")
    table = HistoryTable(spark, scratch_path(spark, "silver_customers_stream"), KEYS, TRACKED, ORDER)
    sink = T.scd2_sink(table)
    schema = _ddl(log)
    for i, (_, drop) in enumerate(D.scd2_batches(log)):
        drop.write.mode("append").parquet(land)
        T.run_available_now(S.stream_files(spark, land, schema), ckpt, sink, f"changes_drop_{i}")
    return table.read().drop("_scd_batch_id")


STREAM_RULES = [Rule("value_above_one", "value > 1", "error", ("value",), "RANGE")]


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: rule value > 1 splits each micro-batch into bronze and quarantine in one write."""
    ev = read(spark, sf_dir, "events")
    land, out, ckpt = (scratch_path(spark, n) for n in ("landing_q", "bronze_q", "ckpt_q"))
    ev.write.parquet(land)
    sink, _ = T.bronze_sink(out, STREAM_RULES, name="events_q")
    T.run_available_now(S.stream_files(spark, land, EVENT_SCHEMA, max_files_per_trigger=2), ckpt, sink, "events_q")
    return T.read_bronze(spark, out).drop("_batch_id")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events plus repeated copies of the click events, in four drops that each span all times;
    duplicates within 10 minutes are set aside."""
    ev = read(spark, sf_dir, "events")
    land, out, ckpt = (scratch_path(spark, n) for n in ("landing_dup", "dedup_events", "ckpt_dup"))
    drop = F.coalesce(F.pmod(F.col("event_id"), F.lit(4)), F.lit(0))
    sink = T.dedup_sink(out, "ts", ["event_id"], "10 minutes", slice_days=7)
    for i in range(4):
        # a copy comes one drop after its row, the copies of the last drop before theirs
        copies = ev.where((F.col("event_type") == "click") & ((drop + 1) % 4 == i))
        ev.where(drop == i).unionByName(copies).write.mode("append").parquet(land)
        T.run_available_now(S.stream_files(spark, land, EVENT_SCHEMA), ckpt, sink, f"events_dedup_{i}")
    return T.read_deduped(spark, out).drop("_batch_id")


QUERIES.update(
    {
        "src_csv_options": src_csv_options,
        "src_json_multiline": src_json_multiline,
        "src_file_glob": src_file_glob,
        "src_files_incremental": src_files_incremental,
        "src_kafka_json": src_kafka_json,
        "scd2_stream": scd2_stream,
        "stream_quarantine": stream_quarantine,
        "stream_dedup": stream_dedup,
    }
)


# --- drift and lineage ----------------------------------------------------------

from ..operators import drift, lineage  # noqa: E402


def json_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.json_key_drift(D.drifting_events(spark, sf_dir), "props", "ts", "day")


def lineage_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = D.yearly_counts(spark, sf_dir)
    return lineage.reconcile(
        c.select("batch_id", F.col("n_source").alias("source_record_count")),
        c.select("batch_id", F.col("n_silver").alias("target_record_count")),
        ["batch_id"],
    )


def lineage_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.two_hops(D.lineage_edges(spark, sf_dir))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.dq_report(D.quality_rows(spark, sf_dir), D.AUDIT_AS_OF, days=7, top=20)


QUERIES.update(
    {
        "json_drift": json_drift,
        "lineage_reconcile": lineage_reconcile,
        "lineage_hops": lineage_hops,
        "dq_report": dq_report,
    }
)


# --- all layers -----------------------------------------------------------------

from .runner import load_table, run_tables  # noqa: E402


def layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer (SCD1 by ingestion time) and orders (APPEND) through bronze, quality
    and silver, then the customer summary over the current customers and all orders."""
    root = scratch_path(spark, "lake")
    log = A.AuditLog(spark, f"{root}/audit")
    log.ensure()
    customers = D.CUSTOMERS_TABLE.with_table(scd_type="SCD1")
    orders = D.ORDERS_TABLE
    c = load_table(spark, customers, read(spark, sf_dir, "customer"), [R.positive("c_acctbal", severity="error")],
                   D.BATCH_ID, D.RUN_TS, root, log)
    o = load_table(spark, orders, read(spark, sf_dir, "orders"), [R.not_null("o_custkey")], D.BATCH_ID, D.RUN_TS, root, log)
    cust = c.silver.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("mktsegment")
    )
    ords = o.silver.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_amount"), F.col("o_orderdate").alias("order_date"),
    )
    return gold.customer_order_summary(cust, ords, attributes=("customer_name", "mktsegment"))


QUERIES["layered_run"] = layered_run


def run_configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables as configured file sources, loaded by ``run_tables`` into silver views, and
    the customer summary written as a gold table and read back."""
    root = scratch_path(spark, "lake")
    log = A.AuditLog(spark, f"{root}/audit")
    log.ensure()
    source = SourceSpec("crm_files", "file", {"path": sf_dir})
    customers = resolve(source, replace(D.CUSTOMERS_TABLE.table, scd_type="SCD1", path=f"{sf_dir}/customer.parquet", format="parquet"))
    orders = resolve(source, replace(D.ORDERS_TABLE.table, path=f"{sf_dir}/orders.parquet", format="parquet"))

    def summary(s: SparkSession) -> DataFrame:
        cust = s.table("silver_crm_files_customers").selectExpr("c_custkey AS customer_id", "c_name AS customer_name", "c_mktsegment AS mktsegment")
        ords = s.table("silver_crm_files_orders").selectExpr(
            "o_orderkey AS order_id", "o_custkey AS customer_id", "o_totalprice AS order_amount", "o_orderdate AS order_date"
        )
        return gold.customer_order_summary(cust, ords, attributes=("customer_name", "mktsegment"))

    rules = {"customers": [R.positive("c_acctbal", severity="error")], "orders": [R.not_null("o_custkey")]}
    out = run_tables(spark, [customers, orders], D.BATCH_ID, D.RUN_TS, root, log, rules=rules, gold={"customer_orders": summary})
    return out["customer_orders"]


QUERIES["run_configured"] = run_configured


def src_rest_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part served as JSON-lines pages; the paged source reads them in parallel."""
    from ..sources import rest

    part = read(spark, sf_dir, "part")
    land = scratch_path(spark, "pages_part")
    part.repartition(8).write.json(land)
    urls = sorted(spark.read.text(land).inputFiles())
    return rest.read_rest(spark, _ddl(part), urls=",".join(urls), pagesPerPartition=2)


QUERIES["src_rest_paged"] = src_rest_paged


def scd2_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its customer's status version valid at the order date."""
    history = scd.scd2_history(D.customer_changes(spark, sf_dir), KEYS, TRACKED, ORDER)
    facts = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"), "o_orderdate", "o_totalprice"
    )
    return scd.as_of_join(facts, history, KEYS, "o_orderdate", ["status", "priority", "_scd_effective_date"], ORDER)


QUERIES["scd2_as_of_join"] = scd2_as_of_join


def dq_email_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 over whole texts: every e-mail-like token of each document, and how many pass the rule."""
    pattern = R.EMAIL_PATTERN
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", F.regexp_extract_all("text", F.lit(r"(\S+@\S+)"), 1).alias("_found")
    )
    return docs.select(
        "doc_id",
        F.size("_found").cast("bigint").alias("n_candidates"),
        F.size(F.filter("_found", lambda x: x.rlike(pattern))).cast("bigint").alias("n_valid_emails"),
    )


QUERIES["dq_email_all"] = dq_email_all


# --- schema evolution and unique keys of a load -----------------------------------


def _loaded(spark: SparkSession, table, parts, rules=()) -> tuple[str, DataFrame]:
    """Loads ``parts`` one after the other; the lake's root and the silver table at the end."""
    root = scratch_path(spark, "lake")
    log = A.AuditLog(spark, f"{root}/audit")
    log.ensure()
    for (batch_id, _), part in zip(D.LOADS, parts, strict=True):
        silver = load_table(spark, table, part, list(rules), batch_id, D.RUN_TS, root, log).silver
    return root, silver


def load_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in three loads: without the priority, whole in another column order, without the status.
    Nothing is lost; what a load does not have is null."""
    orders = read(spark, sf_dir, "orders")
    parts = [D.load_part(orders, "o_orderkey", i) for i in range(3)]
    parts = [parts[0].drop("o_orderpriority"), parts[1].select(*reversed(orders.columns)), parts[2].drop("o_orderstatus")]
    _, silver = _loaded(spark, D.ORDERS_TABLE, parts)
    return silver.select(*orders.columns, F.col("_scd_batch_id").alias("batch_id"))


def load_widened_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in three loads: the customer as int and the price as float-free int; both wider; the
    customer as text that only sometimes is a number. Texts that are none are rescued beside the row."""
    orders = read(spark, sf_dir, "orders")
    cents = F.floor("o_totalprice").cast("int")
    first, second, third = (D.load_part(orders, "o_orderkey", i) for i in range(3))
    code = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("C-"), F.col("o_custkey").cast("string"))).otherwise(F.col("o_custkey").cast("string"))
    parts = [
        first.withColumns({"o_custkey": F.col("o_custkey").cast("int"), "o_totalprice": cents}),
        second.withColumn("o_custkey", F.col("o_custkey") + F.lit(10_000_000_000)),
        third.withColumn("o_custkey", code),
    ]
    _, silver = _loaded(spark, D.ORDERS_TABLE, parts)
    return silver.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", F.col("_rescued_data")["o_custkey"].alias("rescued_custkey")
    )


LINES_TABLE = resolve(
    D.CRM,
    TableSpec("lines", source_table="public.lineitem", primary_key=("l_orderkey", "l_linenumber"), unique_key=True),
)


def dq_unique_across_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem in three loads under the key (order, line): every row, kept or in quarantine, with the
    rule it broke."""
    lines = read(spark, sf_dir, "lineitem")
    root, silver = _loaded(spark, LINES_TABLE, [D.load_part(lines, "l_suppkey", i) for i in range(3)])
    kept = silver.select(*lines.columns, F.col("_scd_batch_id").alias("batch_id"), F.lit(None).cast("string").alias("failed_rules"))
    bad = spark.read.schema("record_data string, failed_rules string, quarantine_timestamp timestamp_ntz, batch_id string").parquet(
        f"{root}/bronze_crm_system_lines_quarantine"
    )
    again = bad.select(F.from_json("record_data", _ddl(lines)).alias("r"), "batch_id", "failed_rules")
    return kept.unionByName(again.select("r.*", "batch_id", "failed_rules"))


QUERIES.update(
    {
        "load_added_column": load_added_column,
        "load_widened_type": load_widened_type,
        "dq_unique_across_loads": dq_unique_across_loads,
    }
)


def lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a lineage graph of chains and cycles, with the fewest hops."""
    return lineage.closure(D.order_lineage(spark, sf_dir))


def json_path_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested paths of events that come, go or change their type from one day with JSON to the next."""
    return drift.json_path_drift(D.nested_events(spark, sf_dir), "props", "ts", "day")


QUERIES.update({"lineage_closure": lineage_closure, "json_path_drift": json_path_drift})


# --- gold kept up by changes ------------------------------------------------------

from ..store import KeyedTable  # noqa: E402


def _order_batches(orders: DataFrame) -> list[DataFrame]:
    """Orders inserted, then changed (amount, customer and date of every third) with new ones, then deleted."""
    part = F.coalesce(F.pmod(F.col("order_id"), F.lit(3)), F.lit(0))
    changed = orders.where(part == 1).withColumns(
        {"order_amount": F.col("order_amount") * 2, "customer_id": F.col("customer_id") + 1, "order_date": F.col("order_date") - F.expr("INTERVAL 400 DAYS")}
    )
    gone = orders.where((part == 2) & (F.col("order_id") % 2 == 0)).withColumn("deleted", F.lit(True))
    return [orders.where(part != 2), changed.unionByName(orders.where(part == 2)), gone]


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 / A1: the order summary per customer, kept up over inserts, updates and deletes of silver orders."""
    orders = read(spark, sf_dir, "orders").where("o_orderkey IS NOT NULL").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("order_amount"),
        F.col("o_orderdate").alias("order_date"), F.lit(False).alias("deleted"),
    )
    root = scratch_path(spark, "lake")
    silver = KeyedTable(spark, f"{root}/silver_orders", ["order_id"], feed=True)
    summary = gold.MaintainedSummary(spark, f"{root}/gold_orders", "customer_id", "order_amount", "order_date")
    spec = TableSpec("orders", primary_key="order_id", scd_type="UPSERT", sequence_by=("deleted",))
    for i, batch in enumerate(_order_batches(orders)):
        rows = silver.apply(batch, f"b{i}", lambda target, b, i=i: scd.apply_scd(target, b, spec, f"b{i}"))
        summary.apply(silver.changes(f"b{i}").where("NOT deleted"), rows.where("NOT deleted"), f"b{i}")
    return summary.read()


def gold_distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: customers per month from stored daily sketches, held against the exact count by the stated error."""
    orders = read(spark, sf_dir, "orders")
    path = scratch_path(spark, "sketches")
    gold.distinct_sketches(orders, "o_custkey", "o_orderdate").write.parquet(path)
    merged = gold.distinct_over(spark.read.parquet(path), "month")
    month = F.date_trunc("month", F.col("o_orderdate")).cast("timestamp_ntz").alias("period")
    exact = orders.groupBy(month).agg(F.count_distinct("o_custkey").alias("unique_customers"))
    off = F.abs(F.col("estimate") - F.col("unique_customers"))
    return exact.join(merged, exact["period"].eqNullSafe(merged["period"])).select(
        exact["period"], "unique_customers", (off <= F.ceil(F.col("unique_customers") * (3 * gold.SKETCH_ERROR))).alias("within_error")
    )


QUERIES.update({"gold_incremental": gold_incremental, "gold_distinct_sketches": gold_distinct_sketches})

"""Bronze -> quality -> silver with audit rows; a failing load is logged and re-raised."""

import pytest
from pyspark.sql import functions as F

from ingestkit.functions import rules as R
from ingestkit.operators.audit import AuditLog
from ingestkit.plans.runner import load_table, run_tables, stored_watermark
from ingestkit.spec import ResolvedTable, SourceSpec, TableSpec

SF = "/root/testdata/sf0.001"


def test_load_table_counts_and_audit(spark, scratch):
    root = scratch("lake")
    log = AuditLog(spark, f"{root}/audit")
    log.ensure()
    table = ResolvedTable(SourceSpec("crm", "file"), TableSpec("customers", primary_key="c_custkey", scd_type="SCD1"))
    cust = spark.read.parquet(f"{SF}/customer.parquet")
    res = load_table(spark, table, cust, [R.positive("c_acctbal", severity="error")], "b1", "2024-01-01 00:00:00", root, log)
    bad = cust.where("NOT (c_acctbal > 0)").count()
    assert (res.rows_read, res.rows_quarantined) == (cust.count(), bad)
    assert res.silver.count() == cust.count() - bad
    run = log.runs().first()
    assert (run.status, run.records_read, run.records_written) == ("SUCCESS", cust.count(), cust.count() - bad)
    rules = {r.rule_name for r in log.table("audit_data_quality").collect()}
    assert rules == {"positive_value__c_acctbal", "valid_primary_key__c_custkey"}
    # the same batch again replaces its bronze partition and leaves silver's rows as they were (in new files)
    before = sorted(map(tuple, res.silver.collect()))
    again = load_table(spark, table, cust, [R.positive("c_acctbal", severity="error")], "b1", "2024-01-01 00:00:00", root, log)
    assert spark.read.parquet(res.bronze_path).count() == cust.count()
    assert sorted(map(tuple, again.silver.collect())) == before


def test_append_loads_only_add_rows(spark, scratch):
    root = scratch("lake")
    log = AuditLog(spark, f"{root}/audit")
    log.ensure()
    table = ResolvedTable(SourceSpec("app", "file"), TableSpec("events", primary_key="event_id", watermark_seconds=3600))
    ev = spark.read.parquet(f"{SF}/events.parquet")
    load_table(spark, table, ev.where("event_id < 100"), [], "b1", "2024-01-01 00:00:00", root, log)
    res = load_table(spark, table, ev.where("event_id >= 90"), [], "b2", "2024-01-02 00:00:00", root, log)
    assert res.silver.count() == ev.count()
    assert res.silver.where(F.col("_scd_batch_id") == "b2").count() == ev.where("event_id >= 100").count()


def test_failed_load_is_logged(spark, scratch):
    root = scratch("lake")
    log = AuditLog(spark, f"{root}/audit")
    log.ensure()
    table = ResolvedTable(SourceSpec("crm", "file"), TableSpec("broken", primary_key="id"))
    bad_df = spark.read.parquet(f"{SF}/customer.parquet").select(F.raise_error(F.lit("source went away")).alias("id"))
    with pytest.raises(Exception):
        load_table(spark, table, bad_df, [], "b9", "2024-01-01 00:00:00", root, log)
    run = log.runs().first()
    assert run.status == "FAILED" and "source went away" in run.error_message


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def test_run_tables_increments_streams_views_and_gold(spark, scratch):
    """An incremental file table and a folder streamed by pattern, run twice: each row lands once."""
    root, land = scratch("lake"), scratch("land")
    log = AuditLog(spark, f"{root}/audit")
    log.ensure()
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.where("event_id < 100").write.parquet(f"{land}/ev")
    src = SourceSpec("app", "file", {"path": f"{land}/ev"})
    by_time = ResolvedTable(src, TableSpec("by_time", primary_key="event_id", incremental_column="ts", load_type="incremental", format="parquet"))
    uploads = ResolvedTable(src, TableSpec("uploads", primary_key="event_id", load_type="incremental", format="parquet", file_pattern="*.parquet"))

    def counts(s):
        return s.sql("SELECT (SELECT count(*) FROM silver_app_by_time) AS a, (SELECT count(*) FROM silver_app_uploads) AS b")

    def run(batch):
        out = run_tables(spark, [by_time, uploads], batch, "2024-01-01 00:00:00", root, log, schemas={"uploads": EVENTS, "by_time": EVENTS},
                         gold={"counts": counts})
        return tuple(out["counts"].first())

    assert stored_watermark(by_time, log) is None
    assert run("b1") == (ev.where("event_id < 100").count(),) * 2
    mark = stored_watermark(by_time, log)
    assert mark == ev.where("event_id < 100").agg(F.max("ts")).first()[0]
    ev.where("event_id >= 100").write.mode("append").parquet(f"{land}/ev")
    new = ev.where((F.col("event_id") < 100) | (F.col("ts") > mark)).count()
    assert run("b2") == (new, ev.count())
    done = [r for r in log.runs().collect() if r.status == "SUCCESS"]
    assert len(done) == 4 and all(r.execution_duration_ms > 0 for r in done)


def test_run_tables_goes_on_after_a_failure(spark, scratch):
    root = scratch("lake")
    log = AuditLog(spark, f"{root}/audit")
    log.ensure()
    gone = ResolvedTable(SourceSpec("crm", "file"), TableSpec("gone", primary_key="id", path=f"{root}/nothing", format="parquet"))
    cust = ResolvedTable(SourceSpec("crm", "file"), TableSpec("ok", primary_key="c_custkey", scd_type="SCD2", path=f"{SF}/customer.parquet", format="parquet"))
    with pytest.raises(RuntimeError, match="silver_crm_gone"):
        run_tables(spark, [gone, cust], "b1", "2024-01-01 00:00:00", root, log)
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert spark.table("silver_crm_ok_current").count() == spark.table("silver_crm_ok_history").count() == n


def test_retry_of_a_failed_batch_shows_running(spark, scratch):
    log = AuditLog(spark, scratch("audit"))
    log.ensure()
    log.log_batch_start("b1", "s", "t", "2024-01-01 00:00:00")
    log.log_batch_failure("b1", "s", "t", "lost", at="2024-01-01 00:00:05", start="2024-01-01 00:00:00")
    assert log.runs().first().status == "FAILED"
    log.log_batch_start("b1", "s", "t", "2024-01-01 00:01:00")
    assert log.runs().first().status == "RUNNING"


def events_table(scd_type="APPEND", **kw):
    return ResolvedTable(SourceSpec("app", "file"), TableSpec("t", primary_key="id", scd_type=scd_type, sequence_by=("ts",), **kw))


def changes(log):
    rows = log.table("audit_schema_evolution").collect()
    return sorted((r.batch_id, r.change_type, r.column_name, r.previous_type, r.new_type) for r in rows)


@pytest.mark.parametrize("scd_type", ["APPEND", "SCD0", "SCD1", "SCD2", "SCD3", "UPSERT"])
def test_loads_keep_added_columns_and_widened_types(spark, scratch, scd_type):
    """Every pattern: a column more, a wider type, another order and a column less, in four loads."""
    root = scratch("lake")
    log = AuditLog(spark, f"{root}/audit")
    log.ensure()
    table = events_table(scd_type)
    day = "2024-01-0{} 00:00:00"
    loads = [
        ("id int, ts timestamp_ntz, n int", "(1, TIMESTAMP_NTZ'2024-01-01', 5), (2, TIMESTAMP_NTZ'2024-01-01', 6)"),
        ("id int, ts timestamp_ntz, n int, extra string", "(3, TIMESTAMP_NTZ'2024-01-02', 7, 'x')"),
        ("extra string, n bigint, ts timestamp_ntz, id bigint", "('y', 50000000000, TIMESTAMP_NTZ'2024-01-03', 4)"),
        ("id bigint, ts timestamp_ntz, n bigint", "(5, TIMESTAMP_NTZ'2024-01-04', 9)"),
    ]
    for i, (schema, values) in enumerate(loads):
        names = ", ".join(x.split()[0] for x in schema.split(", "))
        df = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
        df = df.select(*[F.col(x.split()[0]).cast(x.split()[1]) for x in schema.split(", ")])
        res = load_table(spark, table, df, [], f"b{i}", day.format(i + 1), root, log)
    got = {r.id: (r.n, r.extra) for r in res.silver.collect()}
    assert got == {1: (5, None), 2: (6, None), 3: (7, "x"), 4: (50000000000, "y"), 5: (9, None)}
    assert changes(log) == [
        ("b1", "ADD_COLUMN", "extra", None, "string"),
        ("b2", "TYPE_CHANGE", "id", "int", "bigint"),
        ("b2", "TYPE_CHANGE", "n", "int", "bigint"),
        ("b3", "DROP_COLUMN", "extra", "string", None),
    ]
    if scd_type in ("APPEND", "SCD0"):  # open versions, with the load that brought them
        assert {(r._scd_batch_id, r._scd_is_current, r._scd_end_date) for r in res.silver.collect()} == {(f"b{i}", True, None) for i in range(4)}
    if scd_type == "UPSERT":
        assert {r._scd_action for r in res.silver.collect()} == {"UPSERT"}
    edges = {(r.batch_id, r.source_table, r.target_table, r.source_record_count, r.target_record_count) for r in log.table("audit_lineage").collect()}
    assert ("b0", table.table.origin, "bronze_app_t", 2, 2) in edges and ("b3", "bronze_app_t", "silver_app_t", 1, 1) in edges
    assert len(edges) == 8


def test_values_that_do_not_fit_are_rescued(spark, scratch):
    root = scratch("lake")
    log = AuditLog(spark, f"{root}/audit")
    log.ensure()
    table = events_table()
    first = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2024-01-01' AS ts, 5 AS n, named_struct('a', 1) AS s")
    load_table(spark, table, first, [], "b0", "2024-01-01 00:00:00", root, log)
    second = spark.sql(
        "SELECT * FROM VALUES (2, '7', 'text'), (3, '007', NULL), (4, 'many', ''), (5, NULL, NULL) AS t(id, n, s)"
    ).withColumn("ts", F.lit("2024-01-02").cast("timestamp_ntz"))
    load_table(spark, table, second, [], "b1", "2024-01-02 00:00:00", root, log)
    res = load_table(spark, table, first.withColumns({"id": F.lit(6), "n": F.lit(1.5)}), [], "b2", "2024-01-03 00:00:00", root, log)
    got = {r.id: (r.n, r.s and r.s.a, r._rescued_data) for r in res.silver.collect()}
    assert got == {
        1: (5, 1, None), 2: (7, None, {"s": "text"}), 3: (None, None, {"n": "007"}),
        4: (None, None, {"n": "many", "s": ""}), 5: (None, None, None), 6: (1.5, 1, None),
    }
    assert res.silver.schema["n"].dataType.simpleString() == "double"  # whole numbers and doubles have a common type


def test_unique_keys_across_loads(spark, scratch):
    root = scratch("lake")
    log = AuditLog(spark, f"{root}/audit")
    log.ensure()
    table = events_table(unique_key=True)
    schema = "id bigint, ts timestamp_ntz, v string"
    t0 = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01' AS t").first().t
    loads = [[(1, "a"), (1, "b"), (2, "c"), (2, "c"), (None, "n")], [(2, "late"), (3, "d")], [(3, "e"), (4, "f"), (1, "g"), (4, "h")]]
    for i in (0, 1, 1, 2):  # the second load is retried
        rows = spark.createDataFrame([(k, t0, v) for k, v in loads[i]], schema)
        res = load_table(spark, table, rows, [], f"b{i}", f"2024-01-0{i + 1} 00:00:00", root, log)
    assert sorted((r.id, r.v) for r in res.silver.collect()) == [(1, "a"), (2, "c"), (3, "d"), (4, "f")]
    bad = spark.read.parquet(f"{root}/bronze_app_t_quarantine")
    assert bad.count() == 7 and bad.where("failed_rules LIKE '%unique_primary_key__id%'").count() == 6
    failed = {(r.batch_id, r.rule_name): r.records_failed for r in log.table("audit_data_quality").collect()}
    assert [failed[f"b{i}", "unique_primary_key__id"] for i in range(3)] == [2, 1, 3]
    reasons = {r.reason for r in spark.read.parquet(f"{root}/bronze_app_t_duplicates").collect()}
    assert reasons == {"key repeated in the load", "key loaded before"}


def test_key_filters_let_no_known_key_by_and_few_others(spark, scratch):
    from ingestkit.operators.unique import KnownKeys

    known = KnownKeys(spark, scratch("keys"), ["k"], expected_keys=20_000)
    assert known.hits(spark.range(5).withColumnRenamed("id", "k")) is None
    known.add(spark.range(0, 10_000).withColumnRenamed("id", "k"), "b0")
    known.add(spark.range(10_000, 20_000).withColumnRenamed("id", "k"), "b1")
    assert known.hits(spark.range(20_000).withColumnRenamed("id", "k")).count() == 20_000
    assert known.hits(spark.range(100_000, 120_000).withColumnRenamed("id", "k")).count() < 600
    plan = known.hits(spark.range(9).withColumnRenamed("id", "k"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hash" not in plan  # the test comes before any shuffle


def test_maintained_gold_equals_a_rebuild(spark, scratch):
    """Inserts, updates that move a row to another group or retract its latest time, deletes, and retries."""
    import random
    from datetime import datetime, timedelta

    from ingestkit.operators import gold, scd
    from ingestkit.store import KeyedTable

    rnd = random.Random(5)
    schema = "order_id bigint, customer_id bigint, order_amount double, order_date timestamp_ntz, seq int, deleted boolean"
    silver = KeyedTable(spark, scratch("silver"), ["order_id"], buckets=4, feed=True)
    summary = gold.MaintainedSummary(spark, scratch("gold"), "customer_id", "order_amount", "order_date", buckets=4)
    spec = TableSpec("o", primary_key="order_id", scd_type="UPSERT", sequence_by=("seq",))
    live = {}
    for i in range(4):
        rows = {}
        for _ in range(30):
            k = rnd.randint(0, 60)
            amount = rnd.choice([None, round(rnd.random() * 100, 2)])
            at = rnd.choice([None, datetime(2024, 1, 1) + timedelta(days=rnd.randint(0, 5))])
            rows[k] = (k, rnd.choice([None, 1, 2, 3]), amount, at, i, rnd.random() < 0.2)
        live |= rows
        batch = spark.createDataFrame(list(rows.values()), schema)
        for _ in range(2 if i == 2 else 1):  # one batch is retried whole
            after = silver.apply(batch, f"b{i}", lambda t, b, i=i: scd.apply_scd(t, b, spec, f"b{i}"))
            summary.apply(silver.changes(f"b{i}").where("NOT deleted"), after.where("NOT deleted"), f"b{i}")
        whole = spark.createDataFrame([r for r in live.values() if not r[5]], schema)
        want = whole.groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("order_amount").cast("decimal(28,6)")).cast("double"), F.max("order_date")
        )
        got = summary.read().select("customer_id", "total_orders", "total_order_amount", "last_order_date")
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


def test_distinct_sketches_merge_within_their_error(spark):
    from ingestkit.operators import gold

    rows = spark.range(60_000).selectExpr("id % 20011 AS c", "TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, cast(id % 60 as int)) AS t")
    days = gold.distinct_sketches(rows, "c", "t")
    assert days.count() == 60
    for r in gold.distinct_over(days, "month").collect():
        exact = rows.where(F.date_trunc("month", "t") == F.lit(r.period)).select("c").distinct().count()
        assert abs(r.estimate - exact) <= 3 * gold.SKETCH_ERROR * exact
    assert gold.distinct_over(gold.distinct_sketches(rows.limit(0), "c", "t"), "month").count() == 0


def test_marked_rows_are_read_without_a_join(spark, scratch):
    """rows meet their duplicates once; quarantine, silver and known keys read what was written."""
    from ingestkit.operators.unique import KnownKeys
    from ingestkit.plans.runner import DUPLICATE, ROW, with_duplicates

    def rows(data):
        df = spark.createDataFrame(data, "k bigint, v string").withColumn(ROW, F.monotonically_increasing_id())
        return df.withColumns({"_ingestion_timestamp": F.lit("2024-01-01").cast("timestamp_ntz"), "_batch_id": F.lit("b")})

    known = KnownKeys(spark, scratch("keys"), ["k"], expected_keys=1000)
    out = with_duplicates(spark, rows([(1, "b"), (1, "a"), (2, "x"), (None, "n"), (None, "n")]), known, "b0", scratch("dup"), ["v"])
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.k or 0, r.v, r[DUPLICATE]) for r in out.collect() if r[DUPLICATE]) == [(1, "b", "key repeated in the load")] and out.count() == 5
    known.add(out.where(F.col(DUPLICATE).isNull() & F.col("k").isNotNull()), "b0")
    out = with_duplicates(spark, rows([(1, "c"), (3, "x"), (2, "a"), (2, "b")]), known, "b1", scratch("dup"), ["v"])
    assert {(r.k, r.v) for r in out.collect() if r[DUPLICATE] == "key loaded before"} == {(1, "c"), (2, "a"), (2, "b")} and out.count() == 4
    plan = known.hits(spark.range(9).withColumnRenamed("id", "k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "conv(" not in plan and "shiftleft" in plan

from pyspark.sql import functions as F

from ingestkit.operators import audit as A


def test_audit_log_lifecycle(spark, scratch):
    log = A.AuditLog(spark, scratch("audit"))
    log.ensure()
    log.ensure()  # idempotent
    for name in A.TABLES:
        assert log.table(name).count() == 0
    log.log_batch_start("test_batch_001", "test_source", "test_table", "2024-01-01 00:00:00")
    log.log_batch_success("test_batch_001", "test_source", "test_table", read=1000, written=995,
                          at="2024-01-01 00:00:02.5", watermark="2023-12-31 23:00:00")
    log.log_batch_start("test_batch_002", "test_source", "test_table", "2024-01-01 01:00:00")
    log.log_batch_failure("test_batch_002", "test_source", "test_table", "Connection timeout", at="2024-01-01 01:00:01")
    runs = {r.batch_id: r for r in log.runs().collect()}
    ok, bad = runs["test_batch_001"], runs["test_batch_002"]
    assert (ok.status, ok.records_read, ok.records_written, ok.records_failed) == ("SUCCESS", 1000, 995, 5)
    assert ok.execution_duration_ms == 2500
    assert ok.spark_version == spark.version
    assert (bad.status, bad.error_message) == ("FAILED", "Connection timeout")
    wm = A.high_water_mark(log.runs(), "test_source", "test_table").first()["watermark"]
    assert str(wm) == "2023-12-31 23:00:00"
    assert str(A.high_water_mark(log.runs(), "x", "y").first()["watermark"]) == "1970-01-01 00:00:00"


def test_quality_check_row(spark, scratch):
    log = A.AuditLog(spark, scratch("audit"))
    log.ensure()
    log.log_data_quality_check("b1", "s", "t", "not_null_check", "not_null", checked=1000, passed=995,
                               column="email", severity="ERROR", at="2024-01-01 00:00:00")
    r = log.table("audit_data_quality").first()
    assert (r.records_failed, r.failure_percentage, r.severity, r.is_quarantined) == (5, 0.5, "error", True)
    s = A.dq_summary(log.table("audit_data_quality"), "2024-01-02 00:00:00", days=7).first()
    assert (s.total_checks, s.total_records_failed, s.error_count, s.warn_count) == (1, 5, 1, 0)


def test_reports(spark):
    rows = [("b1", "s", "t", 1, "2024-01-10 00:00:00", None, "RUNNING", None, None, None),
            ("b1", "s", "t", 2, None, "2024-01-10 00:00:01", "SUCCESS", 10, 9, None),
            ("b2", "s", "t", 1, "2024-01-30 12:00:00", None, "RUNNING", None, None, None),
            ("b2", "s", "t", 2, None, "2024-01-30 12:00:05", "FAILED", None, None, "boom")]
    ev = spark.createDataFrame(rows, "batch_id string, source_name string, table_name string, event_seq int, "
                                     "run_start_time string, run_end_time string, status string, records_read bigint, "
                                     "records_written bigint, error_message string")
    ev = ev.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("run_start_time", "run_end_time")})
    runs = A.latest_state(ev)
    assert [r.batch_id for r in A.batch_history(runs, limit=1).collect()] == ["b2"]
    assert [r.batch_id for r in A.failed_batches(runs, "2024-01-31 00:00:00", hours=24).collect()] == ["b2"]
    m = A.pipeline_metrics(runs, "2024-01-31 00:00:00", days=30).first()
    assert (m.total_batches, m.successful_batches, m.failed_batches, m.success_rate) == (2, 1, 1, 50.0)
    empty = A.pipeline_metrics(runs, "2020-01-01 00:00:00", days=1).first()
    assert (empty.total_batches, empty.success_rate) == (0, 0.0)
    assert A.retain(ev, "2024-01-31 00:00:00", days=5).count() > 1
    plan = A.batch_history(runs, limit=5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_schema_and_lineage_rows(spark, scratch):
    from pyspark.sql import types as T

    from ingestkit.operators import drift

    log = A.AuditLog(spark, scratch("audit"))
    log.ensure()
    before = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("x", T.StringType())])
    after = T.StructType([T.StructField("id", T.LongType()), T.StructField("y", T.StringType())])
    diff = drift.schema_diff(spark, before, after)
    log.log_schema_changes(drift.schema_change_rows(diff, "b1", "s", "t", before, after, "2024-01-01 00:00:00"))
    kinds = sorted(r.change_type for r in log.table("audit_schema_evolution").collect())
    assert kinds == ["ADD_COLUMN", "DROP_COLUMN", "TYPE_CHANGE"]
    edge = spark.createDataFrame(
        [("lineage_b1_1", "b1", "s", "public.t", "main", "silver", "silver_s_t", "SCD2", None, 10, 9, None)],
        A.LINEAGE_SCHEMA)
    log.log_lineage(edge)
    assert log.table("audit_lineage").first().target_record_count == 9


def test_old_days_are_dropped_from_disk(spark, scratch):
    log = A.AuditLog(spark, scratch("audit"))
    log.ensure()
    for day in ("2024-01-01", "2024-01-20", "2024-03-01"):
        log.log_batch_start(f"b{day}", "s", "t", f"{day} 23:00:00")
        log.log_batch_success(f"b{day}", "s", "t", read=1, written=1, at=f"{day} 23:59:59", start=f"{day} 23:00:00")
        log.log_data_quality_check(f"b{day}", "s", "t", "r", "NOT_NULL", 1, 1, at=f"{day} 23:30:00")
        log.log_load_lineage(f"b{day}", "s", [("t", "bronze_t", "FULL", 1, 1, "")], f"{day} 23:40:00")
    gone = log.drop_old("2024-03-02 00:00:00", days=42)
    assert gone == {"audit_batch_runs": ["2024-01-01"], "audit_data_quality": ["2024-01-01"], "audit_schema_evolution": [], "audit_lineage": ["2024-01-01"]}
    for name in ("audit_batch_runs", "audit_data_quality", "audit_lineage"):
        assert {r.batch_id for r in log.table(name).collect()} == {"b2024-01-20", "b2024-03-01"}
    assert log.drop_old("2024-03-02 00:00:00", days=42)["audit_batch_runs"] == []

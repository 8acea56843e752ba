from ingestkit.operators import scd
from ingestkit.sources import files as S
from ingestkit.store import HistoryTable
from ingestkit.streaming import ingest as T

SF = "/root/testdata/sf0.001"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def test_restart_reads_only_new_files(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    land, out, ckpt = scratch("land"), scratch("out"), scratch("ckpt")
    sink, seen = T.bronze_sink(out, name="ev")
    ev.where("event_id < 100").write.parquet(land)
    T.run_available_now(S.stream_files(spark, land, EVENTS), ckpt, sink, "r1")
    T.run_available_now(S.stream_files(spark, land, EVENTS), ckpt, sink, "r2")  # nothing new
    ev.where("event_id >= 100").write.mode("append").parquet(land)
    T.run_available_now(S.stream_files(spark, land, EVENTS), ckpt, sink, "r3")
    got = T.read_bronze(spark, out).drop("_batch_id")
    assert got.count() == ev.count() and got.distinct().count() == ev.count()
    assert sum(n for _, n, _ in seen) == ev.count()


def test_quarantine_split_in_one_write(spark, scratch):
    from ingestkit.spec import Rule

    ev = spark.read.parquet(f"{SF}/events.parquet")
    land, out, ckpt = scratch("land"), scratch("out"), scratch("ckpt")
    ev.write.parquet(land)
    sink, seen = T.bronze_sink(out, [Rule("big", "value > 50")], name="q")
    T.run_available_now(S.stream_files(spark, land, EVENTS), ckpt, sink, "q")
    good, bad = T.read_bronze(spark, out), T.read_bronze(spark, out, quarantined=True)
    assert good.count() + bad.count() == ev.count()
    assert good.count() == ev.where("value > 50").count()
    assert sum(q for _, _, q in seen) == bad.count()


def test_replayed_micro_batch_is_applied_once(spark, scratch):
    log = spark.read.parquet(f"{SF}/orders.parquet").selectExpr(
        "o_custkey AS customer_id", "o_orderstatus AS status", "o_orderpriority AS priority",
        "o_orderdate AS updated_at", "o_orderkey AS seq_key")
    table = HistoryTable(spark, scratch("silver"), ["customer_id"], ["status", "priority"], ["updated_at", "seq_key"])
    sink = T.scd2_sink(table)
    sink(log, 0)
    first = sorted(map(tuple, table.read().collect()))
    sink(log, 0)  # replay of the same epoch
    assert sorted(map(tuple, table.read().collect())) == first
    expect = scd.scd2_history(log, ["customer_id"], ["status", "priority"], ["updated_at", "seq_key"])
    assert table.read().count() == expect.count()


def test_stream_audit_rows_per_micro_batch(spark, scratch):
    from ingestkit.operators.audit import AuditLog
    from ingestkit.spec import Rule

    ev = spark.read.parquet(f"{SF}/events.parquet")
    land, out, ckpt = scratch("land"), scratch("out"), scratch("ckpt")
    ev.write.parquet(land)
    log = AuditLog(spark, scratch("audit"))
    log.ensure()
    rules = [Rule("big", "value > 50"), Rule("known", "event_type <> 'error'", "warn")]
    sink, seen = T.bronze_sink(out, rules, name="a", log=log, source="app", table="events")
    T.run_available_now(S.stream_files(spark, land, EVENTS), ckpt, sink, "audited")
    runs = log.runs().collect()
    assert len(runs) == len(seen) and all(r.status == "SUCCESS" for r in runs)
    assert sum(r.records_read for r in runs) == ev.count()
    dq = {r.rule_name: r for r in log.table("audit_data_quality").collect()}
    assert dq["big"].records_failed == ev.where("NOT (value > 50)").count()
    assert dq["known"].records_failed == ev.where("event_type = 'error'").count()


def test_processing_time_trigger(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    land, out, ckpt = scratch("land"), scratch("out"), scratch("ckpt")
    ev.write.parquet(land)
    q = T.start_continuous(S.stream_files(spark, land, EVENTS), ckpt, T.append_sink(out), "continuous", "1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == ev.count()

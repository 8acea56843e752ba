"""Late rows: nothing that arrives is lost, whatever the order of arrival."""

from datetime import datetime, timedelta

from ingestkit.store import HistoryTable
from ingestkit.streaming import ingest as T

T0 = datetime(2024, 1, 1)
SCHEMA = "k bigint, a string, ts timestamp_ntz, seq bigint"


def t(d):
    return T0 + timedelta(days=d)


def test_scd2_sink_places_a_late_row_between_repeats(spark, scratch):
    """A@1, A@2, B@4, then a late C@1.5: A is back from 2 to 4."""
    table = HistoryTable(spark, scratch("late"), ["k"], ["a"], ["ts", "seq"])
    sink = T.scd2_sink(table)
    sink(spark.createDataFrame([(1, "A", t(1), 1), (1, "A", t(2), 2), (1, "B", t(4), 3)], SCHEMA), 0)
    late = spark.createDataFrame([(1, "C", t(1.5), 4)], SCHEMA)
    sink(late, 1)
    want = [("A", t(1), t(1.5)), ("C", t(1.5), t(2)), ("A", t(2), t(4)), ("B", t(4), None)]
    for _ in range(2):
        got = [(r.a, r._scd_effective_date, r._scd_end_date) for r in table.read().orderBy("ts").collect()]
        assert got == want
        sink(late, 1)  # a replay changes nothing


def test_dedup_keeps_late_rows_and_records_repeats(spark, scratch):
    from ingestkit.sources import files as S

    schema = "event_id bigint, ts timestamp_ntz, v string"
    drops = [
        [(1, t(5), "a"), (2, t(5), "b"), (2, t(5), "b")],
        [(3, t(1), "late"), (1, t(5), "a"), (1, t(9), "far"), (None, t(2), "n")],  # days behind the first drop
        [(3, t(1), "late"), (4, t(0), "later"), (5, None, "no time")],
    ]
    land, out, ckpt = scratch("land"), scratch("out"), scratch("ckpt")
    sink = T.dedup_sink(out, "ts", ["event_id"], "10 minutes")
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        stream = S.stream_files(spark, land, schema, max_files_per_trigger=1)
        T.run_available_now(stream, ckpt, sink, f"dedup_{i}")
    sink(spark.createDataFrame(drops[2], schema), 2)  # a replay changes nothing
    kept = sorted((repr(r.event_id), r.v) for r in T.read_deduped(spark, out).collect())
    assert kept == sorted([("1", "a"), ("1", "far"), ("2", "b"), ("3", "late"), ("4", "later"), ("5", "no time"), ("None", "n")])
    repeats = T.read_deduped(spark, out, repeats=True).collect()
    assert sorted(r.event_id for r in repeats) == [1, 2, 3] and all(r._repeat_reason for r in repeats)


def test_dedup_splits_a_hot_key_by_time_and_reads_near_days_only(spark, scratch):
    """One key in every row: neighbours are found across slots, in the batch and in landed rows."""
    import random

    rnd = random.Random(4)
    out, minutes = scratch("hot"), 10
    schema = "event_id bigint, ts timestamp_ntz, v int"
    batches = [[(1, T0 + timedelta(minutes=rnd.randint(0, 3_000)), i) for i in range(60)] for _ in range(3)]
    sink = T.dedup_sink(out, "ts", ["event_id"], f"{minutes} minutes")
    landed, want = [], []
    for i, rows in enumerate(batches):
        sink(spark.createDataFrame(rows, schema), i)
        before = None
        for r in sorted(rows, key=lambda r: (r[1], r[2])):
            near = any(abs(r[1] - x) <= timedelta(minutes=minutes) for x in landed)
            again = before is not None and r[1] - before <= timedelta(minutes=minutes)
            want.append((r[1], r[2], near or again))
            before = r[1]
        landed += [r[1] for r in rows]
    kept = {(r.ts, r.v, False) for r in T.read_deduped(spark, out).collect()}
    repeats = {(r.ts, r.v, True) for r in T.read_deduped(spark, out, repeats=True).collect()}
    assert kept | repeats == set(want) and kept and repeats


def test_dedup_does_not_touch_days_far_from_a_batch(spark, scratch):
    """Files of other days may even be unreadable: a batch reads the days around its own rows."""
    import glob
    import os

    out = scratch("days")
    schema = "event_id bigint, ts timestamp_ntz"
    sink = T.dedup_sink(out, "ts", ["event_id"], "10 minutes")
    sink(spark.createDataFrame([(1, t(0)), (1, t(20))], schema), 0)
    for f in glob.glob(f"{out}/_slice=19723/**/*.parquet", recursive=True):
        with open(f, "wb") as broken:
            broken.write(b"not parquet")
        os.path.exists(crc := os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")) and os.unlink(crc)
    sink(spark.createDataFrame([(1, t(20) + timedelta(minutes=5)), (2, t(20))], schema), 1)
    near = spark.read.parquet(f"{out}/_slice=19743")
    assert sorted((r.event_id, r._is_repeat) for r in near.collect()) == [(1, "false"), (1, "true"), (2, "false")]

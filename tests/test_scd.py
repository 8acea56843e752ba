"""SCD patterns on hand-made frames, checked against brute force and by properties."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ingestkit.operators import quality, scd
from ingestkit.operators.sequence import with_neighbors
from ingestkit.store import BUCKET, HistoryTable, KeyedTable, bucket_of

T0 = datetime(2024, 1, 1)
SCHEMA = "k bigint, a string, b string, ts timestamp_ntz, seq bigint"
KEYS, TRACKED, ORDER = ["k"], ["a", "b"], ["ts", "seq"]


def t(d):
    return T0 + timedelta(days=d)


# One change log covering: new key, changed value, same value, NULL -> value,
# value -> NULL, two changes of one key in a batch, A -> B -> A, ties on ts.
LOG = [
    (1, "x", "p", t(0), 1), (1, "y", "p", t(5), 2), (1, "z", "p", t(6), 3),
    (2, "s", "q", t(0), 4), (2, "s", "q", t(7), 5),
    (3, "n", None, t(1), 6), (3, "n", "v", t(8), 7),
    (4, "m", "w", t(1), 8), (4, None, "w", t(9), 9),
    (6, "A", "r", t(2), 10), (6, "B", "r", t(3), 11), (6, "A", "r", t(4), 12),
    (7, "e", "f", t(3), 13), (7, "g", "f", t(3), 14),
    (5, "new", "n", t(8), 15),
]


def brute_history(rows):
    out = []
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[0], r[3], r[4], r[1] or "", r[2] or "")):
        by_key.setdefault(r[0], []).append(r)
    for k, rs in by_key.items():
        kept = [r for i, r in enumerate(rs) if i == 0 or (r[1], r[2]) != (rs[i - 1][1], rs[i - 1][2])]
        for i, r in enumerate(kept):
            end = kept[i + 1][3] if i + 1 < len(kept) else None
            out.append((r[0], r[1], r[2], r[3], r[4], r[3], end, end is None and i == len(kept) - 1))
    return sorted(out, key=repr)


def rows_of(df):
    cols = ["k", "a", "b", "ts", "seq", "_scd_effective_date", "_scd_end_date", "_scd_is_current"]
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=repr)


@pytest.fixture
def log(spark):
    return spark.createDataFrame(LOG, SCHEMA)


def test_history_matches_brute_force(log):
    assert rows_of(scd.scd2_history(log, KEYS, TRACKED, ORDER)) == brute_history(LOG)


def test_history_of_divided_keys_matches(log):
    # range_rows=1 cuts at nearly every row.
    assert rows_of(scd.scd2_history(log, KEYS, TRACKED, ORDER, range_rows=1)) == brute_history(LOG)


@pytest.mark.parametrize("cuts", [[3], [1, 5], [0, 2, 4, 6, 8]])
def test_merge_fold_equals_history(log, cuts):
    bounds = [None] + [t(c) for c in cuts] + [None]
    table = scd.empty_scd2(log)
    for i in range(len(bounds) - 1):
        part = log
        if bounds[i] is not None:
            part = part.where(F.col("ts") >= F.lit(bounds[i]))
        if bounds[i + 1] is not None:
            part = part.where(F.col("ts") < F.lit(bounds[i + 1]))
        # cut the lineage after each merge, as the snapshot store does
        table = scd.scd2_merge(table, part, KEYS, TRACKED, ORDER, f"b{i}").checkpoint()
    assert rows_of(table) == brute_history(LOG)
    checks = quality.scd2_checks(table, KEYS).first()
    assert tuple(checks) == (0, 0, 0)


def test_merge_twice_equals_once(log):
    once = scd.scd2_merge(scd.empty_scd2(log), log, KEYS, TRACKED, ORDER, "b1")
    twice = scd.scd2_merge(once, log, KEYS, TRACKED, ORDER, "b1")
    assert rows_of(twice) == rows_of(once)
    assert sorted(r._scd_batch_id for r in twice.collect()) == sorted(r._scd_batch_id for r in once.collect())


def test_late_row_lands_in_place(spark):
    first = spark.createDataFrame([(2, "A", "q", t(1), 1), (2, "B", "q", t(3), 3)], SCHEMA)
    late = spark.createDataFrame([(2, "C", "q", t(2), 2)], SCHEMA)
    table = scd.scd2_merge(scd.empty_scd2(first), first, KEYS, TRACKED, ORDER, "b1")
    table = scd.scd2_merge(table, late, KEYS, TRACKED, ORDER, "b2")
    got = [(r.a, r._scd_effective_date, r._scd_end_date) for r in table.orderBy("ts").collect()]
    assert got == [("A", t(1), t(2)), ("C", t(2), t(3)), ("B", t(3), None)]


def test_as_of_and_current(log):
    h = scd.scd2_history(log, KEYS, TRACKED, ORDER)
    assert sorted(r.k for r in scd.current(h).collect()) == [1, 2, 3, 4, 5, 6, 7]
    at = {r.k: r.a for r in scd.as_of(h, t(5) + timedelta(hours=1)).collect()}
    assert at == {1: "y", 2: "s", 3: "n", 4: "m", 6: "A", 7: "g"}


def _target(spark):
    rows = [(1, "x", "p", t(0), 1), (2, "s", "q", t(0), 4), (3, "n", None, t(1), 6), (4, "m", "w", t(1), 8)]
    return spark.createDataFrame(rows, SCHEMA).withColumns(
        {"_scd_type": F.lit("SCD1"), "_scd_action": F.lit("INSERT"), "_scd_batch_id": F.lit("b0")}
    )


BATCH = [(1, "y", "p", t(5), 2), (1, "z", "p", t(6), 3), (2, "s", "q", t(7), 5), (3, "n", "v", t(8), 7),
         (4, None, "w", t(9), 9), (5, "new", "n", t(8), 15)]


def test_scd1_overwrites_with_latest(spark):
    out = {r.k: (r.a, r.b, r._scd_action) for r in scd.scd1(_target(spark), spark.createDataFrame(BATCH, SCHEMA), KEYS, TRACKED, ORDER, "b1").collect()}
    assert out == {1: ("z", "p", "UPDATE"), 2: ("s", "q", "UNCHANGED"), 3: ("n", "v", "UPDATE"),
                   4: (None, "w", "UPDATE"), 5: ("new", "n", "INSERT")}


def test_scd0_inserts_only_new_keys(spark):
    out = {r.k: r.a for r in scd.scd0(_target(spark), spark.createDataFrame(BATCH, SCHEMA), KEYS, ORDER, "b1").collect()}
    assert out == {1: "x", 2: "s", 3: "n", 4: "m", 5: "new"}


def test_upsert_and_append(spark):
    tgt = _target(spark).drop("_scd_type", "_scd_action", "_scd_batch_id")
    ch = spark.createDataFrame(BATCH, SCHEMA)
    up = {r.k: r.a for r in scd.upsert(tgt, ch, KEYS, ORDER).collect()}
    assert up == {1: "z", 2: "s", 3: "n", 4: None, 5: "new"}
    app = scd.append(tgt, ch.unionByName(tgt), dedup_keys=["k", "seq"])
    assert app.count() == 4 + len(BATCH)


def test_scd3_previous_values(spark, log):
    out = {r.k: r for r in scd.scd3(None, log, KEYS, TRACKED, ORDER, "b1").collect()}
    assert (out[6].a, out[6].a_previous, out[6].a_change_date) == ("A", "B", t(4))
    assert (out[1].a, out[1].a_previous, out[1].a_change_date) == ("z", "y", t(6))
    assert (out[2].a_previous, out[2].a_change_date) == (None, None)
    assert (out[3].b, out[3].b_previous, out[3].b_change_date) == ("v", None, t(8))
    # two batches give the same answer as one
    first = scd.scd3(None, log.where(F.col("ts") < F.lit(t(4))), KEYS, TRACKED, ORDER, "b1")
    both = scd.scd3(first, log.where(F.col("ts") >= F.lit(t(4))), KEYS, TRACKED, ORDER, "b2")
    cols = [c for c in both.columns if c != "_scd_batch_id"]
    assert sorted(map(tuple, both.select(cols).collect()), key=repr) == sorted(
        [tuple(r[c] for c in cols) for r in out.values()], key=repr)


def test_latest_per_key_full_tie_break(spark):
    d = spark.createDataFrame([(1, t(1), "a"), (1, t(2), "b"), (1, t(2), "c"), (2, t(0), "z")], "k int, ts timestamp_ntz, v string")
    assert {r.k: r.v for r in scd.latest_per_key(d, ["k"], ["ts"]).collect()} == {1: "c", 2: "z"}


def test_with_neighbors_divided_keys_random(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice([1, 1, 1, 1, 2, 3]), i, rnd.randint(0, 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, s int, v int")
    expect = {}
    for k in {r[0] for r in rows}:
        rs = sorted([r for r in rows if r[0] == k], key=lambda r: r[1])
        for i, r in enumerate(rs):
            expect[r[1]] = (rs[i - 1][2] if i else None, rs[i + 1][2] if i + 1 < len(rs) else None, i == 0, i == len(rs) - 1)
    for size in (1, 5, 40, 10**9):
        out = with_neighbors(df, ["k"], ["s"], prev_cols=["v"], next_cols=["v"], range_rows=size)
        got = {r.s: (r._prev_v, r._next_v, r._is_first, r._is_last) for r in out.collect()}
        assert got == expect


def files(spark, path):
    return sorted(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "modificationTime").collect())


def test_store_rebuilds_only_the_buckets_of_a_batch(spark, scratch, log):
    table = HistoryTable(spark, scratch("scd2"), KEYS, TRACKED, ORDER)
    bounds = [None, t(3), t(6), None]
    for i in range(3):
        part = log
        if bounds[i] is not None:
            part = part.where(F.col("ts") >= F.lit(bounds[i]))
        if bounds[i + 1] is not None:
            part = part.where(F.col("ts") < F.lit(bounds[i + 1]))
        hist = table.load(part, f"b{i}")
    assert rows_of(hist) == brute_history(LOG)
    # a replayed batch changes nothing
    assert rows_of(table.load(log.where(F.col("ts") < F.lit(t(3))), "b0")) == brute_history(LOG)
    before = files(spark, table.versions)
    row = (6, "C", "r", t(2) + timedelta(hours=12), 99)
    hist = table.load(spark.createDataFrame([row], SCHEMA), "late")
    assert rows_of(hist) == brute_history(LOG + [row])
    after = files(spark, table.versions)
    bucket = spark.createDataFrame([row], SCHEMA).select(bucket_of(KEYS, table.buckets)).first()[0]
    new = {f.path for f in after} - {f.path for f in before}
    gone = {f.path for f in before} - {f.path for f in after}
    assert new and all(f"/{BUCKET}={bucket}/" in p for p in new | gone)  # one late row: one bucket
    assert rows_of(table.current()) == [r for r in rows_of(hist) if r[-1]]


def test_store_reads_only_folders_of_the_buckets(spark, scratch, log):
    table = HistoryTable(spark, scratch("pruned"), KEYS, TRACKED, ORDER)
    table.load(log, "b0")
    plan = table._in(table.landed(), [3])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan and f"({BUCKET}" in plan.split("PartitionFilters")[1]
    plan = table.current()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_scd_is_current" in plan


def test_store_takes_new_columns(spark, scratch, log):
    """A column more rebuilds every bucket, so versions and hashes follow one set of columns."""
    table = HistoryTable(spark, scratch("wider"), KEYS, None, ORDER)
    table.load(log, "b0")
    more = spark.createDataFrame([(1, "z", "p", t(6.5), 50, "c")], SCHEMA + ", c string")
    hist = table.load(more, "b1")
    whole = log.withColumn("c", F.lit(None).cast("string")).unionByName(more)
    want = scd.scd2_history(whole, KEYS, ["a", "b", "c"], ORDER)
    columns = [*whole.columns, "_scd_effective_date", "_scd_end_date", "_scd_is_current", "_scd_hash", "_scd_action"]
    assert sorted(map(repr, hist.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))


def test_keyed_table_rewrites_only_the_buckets_of_a_batch(spark, scratch):
    rows = [(k, "v", "w", t(0), k) for k in range(40)]
    table = KeyedTable(spark, scratch("scd1"), KEYS)

    def change(target, batch, batch_id):
        from ingestkit.spec import TableSpec

        return scd.apply_scd(target, batch, TableSpec("x", primary_key="k", scd_type="SCD1", sequence_by=("ts", "seq")), batch_id)

    table.apply(spark.createDataFrame(rows, SCHEMA), "b0", lambda x, y: change(x, y, "b0"))
    before = files(spark, table.root)
    second = spark.createDataFrame([(7, "new", "w", t(1), 100), (7, "newer", "w", t(2), 101)], SCHEMA)
    for _ in range(2):  # the second time is a retry: labels stay
        got = table.apply(second, "b1", lambda x, y: change(x, y, "b1"))
        by_key = {r.k: r for r in got.collect()}
        assert len(by_key) == got.count() == 40
        assert (by_key[7].a, by_key[7]._scd_action, by_key[7]._scd_batch_id) == ("newer", "UPDATE", "b1")
        assert (by_key[8].a, by_key[8]._scd_action, by_key[8]._scd_batch_id) == ("v", "INSERT", "b0")
    same = {f.path for f in before} & {f.path for f in files(spark, table.root)}
    assert len(same) == len(before) - 1


def test_fill_forward_divided_keys_random(spark):
    from ingestkit.operators.sequence import fill_forward

    rnd = random.Random(11)
    rows = [(rnd.choice([1, 1, 1, 2]), i, rnd.choice([None, None, None, rnd.randint(0, 9)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, s int, v int")
    expect, last = {}, {}
    for k, s_, v in sorted(rows, key=lambda r: (r[0], r[1])):
        if v is not None:
            last[k] = v
        expect[s_] = last.get(k)
    for size in (1, 4, 10**9):
        got = {r.s: r._filled for r in fill_forward(df, ["k"], ["s"], "v", range_rows=size).collect()}
        assert got == expect


@pytest.mark.parametrize("size", [1, 10**9])
def test_as_of_join_matches_range_join(spark, log, size):
    h = scd.scd2_history(log, KEYS, TRACKED, ORDER)
    facts = spark.createDataFrame([(i, k, t(d) + timedelta(hours=h_)) for i, (k, d, h_) in enumerate(
        [(1, 0, 0), (1, 5, 0), (1, 5, 12), (6, 3, 1), (6, 4, 0), (7, 3, 0), (9, 1, 0), (3, -1, 0), (2, 9, 0)])],
        "id int, k bigint, at timestamp_ntz")
    got = scd.as_of_join(facts, h, KEYS, "at", ["a", "b"], ORDER, range_rows=size)
    hist = [r for r in h.collect()]
    expect = set()
    for f in facts.collect():
        match = [r for r in hist if r.k == f.k and r._scd_effective_date <= f.at and (r._scd_end_date is None or f.at < r._scd_end_date)]
        assert len(match) <= 1
        expect.add((f.id, match[0].a if match else None, match[0].b if match else None))
    assert {(r.id, r.a, r.b) for r in got.collect()} == expect


def test_action_labels_survive_merges_and_late_rows(spark, scratch, log):

    def labels(df):
        rows = sorted(df.select("k", "_scd_effective_date", "seq", "_scd_action").collect(), key=lambda r: (r.k, r[1], r.seq))
        return [(r.k, r._scd_action) for r in rows]

    def expected(df):
        rows = sorted(df.select("k", "_scd_effective_date", "seq").collect(), key=lambda r: (r.k, r[1], r.seq))
        return [(r.k, "INSERT" if i == 0 or rows[i - 1].k != r.k else "UPDATE") for i, r in enumerate(rows)]

    table = HistoryTable(spark, scratch("labels"), KEYS, TRACKED, ORDER)
    table.load(log.where(F.col("ts") < F.lit(t(4))), "b1")
    hist = table.load(log.where(F.col("ts") >= F.lit(t(4))), "b2")
    assert labels(hist) == expected(hist)
    late = spark.createDataFrame([(6, "Z", "r", t(1), 0)], SCHEMA)  # becomes key 6's first version
    hist = table.load(late, "late")
    assert labels(hist) == expected(hist)


def _versions(df):
    return [(r.a, r._scd_effective_date, r._scd_end_date) for r in df.orderBy("ts").collect()]


def test_late_row_between_repeats(spark, scratch):
    """A was seen again after the late B, so A comes back after it."""
    first = spark.createDataFrame([(1, "A", "q", t(1), 1)], SCHEMA)
    again = spark.createDataFrame([(1, "A", "q", t(5), 2)], SCHEMA)
    late = spark.createDataFrame([(1, "B", "q", t(3), 3)], SCHEMA)
    want = [("A", t(1), t(3)), ("B", t(3), t(5)), ("A", t(5), None)]
    table = scd.empty_scd2(first)
    for i, part in enumerate([first, again, late]):
        table = scd.scd2_merge(table, part, KEYS, TRACKED, ORDER, f"b{i}").checkpoint()
    assert _versions(table) == want
    store = HistoryTable(spark, scratch("late"), KEYS, TRACKED, ORDER)
    for i, part in enumerate([first, again, late]):
        hist = store.load(part, f"b{i}")
    assert _versions(hist) == want


def test_shuffled_batches_with_log_equal_history(spark, scratch):
    """Rows in any order of arrival, with the log of all rows: the history of the whole log."""
    for seed in (3,):
        rnd = random.Random(seed)
        rows = [(rnd.choice([1, 2, 3]), rnd.choice("xy"), "p", t(rnd.randint(0, 9)), i) for i in range(45)]
        store = HistoryTable(spark, scratch("shuffled"), KEYS, TRACKED, ORDER)
        parts = [rnd.sample(rows, 45)[:30], rows[:25], rows[20:]]
        seen = []
        for i, part in enumerate(parts):
            seen += part
            hist = store.load(spark.createDataFrame(part, SCHEMA), f"b{i}")
        assert rows_of(hist) == brute_history(rows)


def test_null_keys_are_one_key(spark, scratch):
    store = HistoryTable(spark, scratch("nullkey"), KEYS, TRACKED, ORDER)
    for i, a in enumerate("xyz"):
        hist = store.load(spark.createDataFrame([(None, a, "p", t(i), i)], SCHEMA), f"b{i}")
    assert _versions(hist) == [("x", t(0), t(1)), ("y", t(1), t(2)), ("z", t(2), None)]


def test_reread_rows_change_nothing(spark, scratch):
    store = HistoryTable(spark, scratch("reread"), KEYS, TRACKED, ORDER)
    store.load(spark.createDataFrame([(1, "x", "p", t(0), 1), (2, "y", "p", t(1), 2)], SCHEMA), "b0")
    hist = store.load(spark.createDataFrame([(1, "x", "p", t(0), 1), (2, "z", "p", t(2), 3)], SCHEMA), "b1")
    rows = {(r.k, r.a, r._scd_batch_id, r._scd_is_current) for r in hist.collect()}
    assert rows == {(1, "x", "b0", True), (2, "y", "b0", False), (2, "z", "b1", True)}

"""Ranges over (key, order) give the rows of one window per key, for any orderable columns."""

import random

import pytest
from pyspark.sql import functions as F

from ingestkit.operators.sequence import fill_forward, range_cuts, with_neighbors

SCHEMA = "k bigint, s string, n int, v string"
WORDS = ["a1", "b", "zz", "m", None]
NUMBERS = ["10", "9", "100", "2", "33"]  # as strings: 10, 100, 2, 33, 9


def results(df, keys, order, size):
    a = with_neighbors(df, keys, order, prev_cols=["v"], next_cols=["v"], range_rows=size)
    b = fill_forward(df, keys, order, "v", range_rows=size)
    return [sorted(map(repr, x.select(*sorted(x.columns)).collect())) for x in (a, b)]


@pytest.mark.parametrize("values", [WORDS, NUMBERS, ["same"]])
def test_string_order_across_ranges(spark, values):
    rows = [(k, s, i, f"{s}{i}" if i % 3 else None) for k in (1, None) for s in values for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert results(df, ["k"], ["s", "n"], 5) == results(df, ["k"], ["s", "n"], 10**9)


@pytest.mark.parametrize("size", [1, 7, 60, 10**9])
def test_against_a_plain_loop(spark, size):
    """One key with a third of the rows, a null key, keys of one row, runs without values longer than a range."""
    rnd = random.Random(3)
    keys = [("hot", 1)] * 200 + [(None, 1)] * 60 + [("a", None)] * 60 + [(f"k{i}", i % 3) for i in range(280)]
    rows = [(*k, rnd.choice([None, 1.5, -2.0, 7.25]), i, f"v{i}" if rnd.random() < 0.05 else None) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, j int, x double, i int, v string")

    def null_first(x):
        return (x is not None, x if x is not None else 0)

    want = {}
    for key in set(keys):
        mine = sorted((r for r in rows if r[:2] == key), key=lambda r: (null_first(r[2]), r[3]))
        filled = None
        for n, r in enumerate(mine):
            filled = r[4] if r[4] is not None else filled
            before, after = mine[n - 1] if n else None, mine[n + 1] if n + 1 < len(mine) else None
            want[r[3]] = (before and before[4], after and after[4], n == 0, after is None, filled)
    a = with_neighbors(df, ["k", "j"], ["x", "i"], prev_cols=["v"], next_cols=["v"], range_rows=size)
    b = fill_forward(df, ["k", "j"], ["x", "i"], "v", range_rows=size)
    got = {r.i: (r._prev_v, r._next_v, r._is_first, r._is_last) for r in a.collect()}
    filled = {r.i: r._filled for r in b.collect()}
    assert {i: (*got[i], filled[i]) for i in got} == want and len(got) == len(rows)


def test_cuts_are_shared_by_a_subset_that_leaves_ranges_empty(spark):
    df = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id").alias("s"), F.col("id").alias("v"))
    cuts = range_cuts(df, ["k"], ["s"], 10)
    few = df.where("s < 20 or s > 280")
    out = with_neighbors(few, ["k"], ["s"], prev_cols=["v"], next_cols=["v"], cuts=cuts)
    got = {r.s: (r._prev_v, r._next_v) for r in out.collect()}
    assert got[18] == (16, 282) and got[282] == (18, 284) and got[0] == (None, 2) and got[299] == (297, None)
    assert len(got) == few.count()


def test_a_hot_key_is_divided_and_equal_rows_are_one_cut(spark):
    hot = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("s"))

    def starts(df, size):
        return spark.range(1).select(range_cuts(df, ["k"], ["s"], size).starts().alias("at")).first()["at"]

    at = starts(hot, 100)
    assert 20 <= len(at) <= 60 and sum(c.c0 == "hot" for c in at) >= 8
    same = spark.range(1000).select(F.lit(1).alias("k"), F.lit(2).alias("s"))
    assert len(starts(same, 10)) == 1
    assert range_cuts(hot.limit(0), ["k"], ["s"], 10) is None


def test_the_cuts_are_a_literal_and_rows_are_shuffled_once(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("s"), F.col("id").alias("v"))
    out = with_neighbors(df, ["k"], ["s"], prev_cols=["v"], range_rows=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "JsonToStructs" not in plan and "hashpartitioning(k" in plan


def test_only_keys_that_hold_two_cuts_are_divided(spark):
    """Rows of small keys are not searched for among the cuts, and nothing is counted first."""
    small = spark.range(4000).select((F.col("id") / 4).cast("int").alias("k"), F.col("id").alias("s"), F.col("id").alias("v"))
    cuts = range_cuts(small, ["k"], ["s"], 100)
    assert cuts.divided == ()
    plan = with_neighbors(small, ["k"], ["s"], prev_cols=["v"], cuts=cuts)._jdf.queryExecution().optimizedPlan().toString()
    assert "_sub" not in plan and "Join" not in plan
    hot = small.withColumn("k", F.when(F.col("s") % 3 == 0, -1).otherwise(F.col("k")))
    cuts = range_cuts(hot, ["k"], ["s"], 100)
    assert list(cuts.divided) == [hot.where("k = -1").select(F.xxhash64("k")).first()[0]]

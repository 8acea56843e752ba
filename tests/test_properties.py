"""Property: folding SCD2 merges over any in-order split of a random change log equals the
history built from the whole log, and every result passes the SCD2 checks."""

import random
from datetime import datetime, timedelta

import pytest

from ingestkit.operators import quality, scd
from ingestkit.store import HistoryTable

SCHEMA = "k bigint, a string, b string, ts timestamp_ntz, seq bigint"
T0 = datetime(2024, 1, 1)


def brute(rows):
    out = []
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[3], r[4], r[1] or "", r[2] or "")):
        by.setdefault(r[0], []).append(r)
    for rs in by.values():
        kept = [r for i, r in enumerate(rs) if i == 0 or (r[1], r[2]) != (rs[i - 1][1], rs[i - 1][2])]
        for i, r in enumerate(kept):
            end = kept[i + 1][3] if i + 1 < len(kept) else None
            out.append((r[0], r[1], r[2], r[3], r[4], end, i == len(kept) - 1))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_log_split_fold(spark, scratch, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(120):
        k = rnd.choice([1, 1, 1, 2, 3, 4])  # key 1 is hot
        rows.append((k, rnd.choice(["x", "y", None]), rnd.choice(["p", None]), T0 + timedelta(hours=rnd.randint(0, 48)), i))
    cuts = sorted(rnd.sample(range(1, 48), 2))
    table = HistoryTable(spark, scratch("prop"), ["k"], ["a", "b"], ["ts", "seq"])
    bounds = [0] + cuts + [49]
    for j in range(len(bounds) - 1):
        part = [r for r in rows if T0 + timedelta(hours=bounds[j]) <= r[3] < T0 + timedelta(hours=bounds[j + 1])]
        hist = table.load(spark.createDataFrame(part, SCHEMA), f"b{j}")
    cols = ["k", "a", "b", "ts", "seq", "_scd_end_date", "_scd_is_current"]
    assert sorted(map(tuple, hist.select(cols).collect()), key=repr) == brute(rows)
    assert tuple(quality.scd2_checks(hist, ["k"]).first()) == (0, 0, 0)
    hot = scd.scd2_history(spark.createDataFrame(rows, SCHEMA), ["k"], ["a", "b"], ["ts", "seq"], range_rows=10)
    assert sorted(map(tuple, hot.select(cols).collect()), key=repr) == brute(rows)

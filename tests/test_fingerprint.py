import duckdb

from ingestkit.functions.fingerprint import fingerprint, fingerprint_sql

# FIXTURES D: pairs that must hash differently.
PAIRS = [((None, "a"), ("a", None)), (("ab", "c"), ("a", "bc")), (("a||b", ""), ("a", "b||")), (("\\N", "x"), (None, "x"))]


def test_pairs_differ_and_match_sql(spark):
    rows = [r for pair in PAIRS for r in pair] + [("same", "v"), ("same", "v")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(fingerprint(["a", "b"])).collect()]
    for i in range(len(PAIRS)):
        assert got[2 * i] != got[2 * i + 1]
    assert got[-1] == got[-2]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, *r) for i, r in enumerate(rows)])
    expect = [r[0] for r in con.execute(f"SELECT {fingerprint_sql(['a', 'b'])} FROM t ORDER BY i").fetchall()]
    assert got == expect

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestkit.operators import drift, lineage


def test_schema_diff(spark):
    before = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("gone", T.StringType())])
    after = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                          T.StructField("added", T.DoubleType())])
    got = {r.column_name: (r.change_type, r.previous_type, r.new_type) for r in drift.schema_diff(spark, before, after).collect()}
    assert got == {"id": ("TYPE_CHANGE", "int", "bigint"), "gone": ("DROP_COLUMN", "string", None),
                   "added": ("ADD_COLUMN", None, "double")}
    rows = drift.schema_change_rows(drift.schema_diff(spark, before, after), "b1", "s", "t", before, after, "2024-01-01")
    assert rows.count() == 3


def test_json_key_drift(spark):
    rows = [("2024-01-01 10:00:00", '{"a": 1}'), ("2024-01-01 11:00:00", '{"a": 2}'), ("2024-01-02 10:00:00", '{"a": 1, "b": 2}')]
    df = spark.createDataFrame(rows, "ts string, p string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {(str(r.period)[:10], r.json_key): (r.n_rows, r.is_new_key) for r in drift.json_key_drift(df, "p", "ts").collect()}
    assert got == {("2024-01-01", "a"): (2, True), ("2024-01-02", "a"): (1, False), ("2024-01-02", "b"): (1, True)}


def test_reconcile_and_hops(spark):
    src = spark.createDataFrame([("b1", 10), ("b2", 5)], "batch_id string, source_record_count long")
    tgt = spark.createDataFrame([("b1", 10), ("b3", 1)], "batch_id string, target_record_count long")
    got = {r.batch_id: r.status for r in lineage.reconcile(src, tgt, ["batch_id"]).collect()}
    assert got == {"b1": "OK", "b2": "MISSING", "b3": "MISSING"}
    edges = spark.createDataFrame([("b1", "raw", "bronze", 10, 10), ("b1", "bronze", "silver", 10, 8), ("b2", "bronze", "silver", 1, 1)],
                                  "batch_id string, source_table string, target_table string, source_record_count long, target_record_count long")
    hops = [tuple(r) for r in lineage.two_hops(edges).collect()]
    assert hops == [("b1", "raw", "bronze", "silver", 10, 8)]


def test_closure_of_chains_diamonds_and_cycles(spark):
    from ingestkit.operators import lineage

    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "d"), ("x", "y"), ("y", "x"), ("y", "z"), ("s", "s"), ("a", "b"), (None, "a"), ("d", None)]
    edges += [(f"n{i}", f"n{i + 1}") for i in range(20)]
    got = {(r.upstream, r.downstream): (r.hops, r.in_cycle) for r in lineage.closure(
        spark.createDataFrame(edges, "source_table string, target_table string")).collect()}
    out = {}
    for a, b in edges:
        if a and b:
            out.setdefault(a, set()).add(b)
    want = {}
    for start in out:
        seen, front, hops = {}, {start}, 0
        while front:
            hops += 1
            front = {b for a in front for b in out.get(a, ()) if b not in seen}
            seen |= dict.fromkeys(front, hops)
        want |= {(start, b): h for b, h in seen.items()}
    assert got == {k: (h, (k[1], k[0]) in want) for k, h in want.items()}
    paths = lineage.closure(spark.createDataFrame(edges, "source_table string, target_table string"))
    assert {r.table_name for r in lineage.upstream_of(paths, "d").collect()} == {"a", "b", "c"}
    assert {r.table_name: r.hops for r in lineage.downstream_of(paths, "a").collect()} == {"b": 1, "c": 2, "d": 1}
    assert lineage.closure(spark.createDataFrame([], "source_table string, target_table string")).count() == 0


def test_json_path_drift_names_nested_changes(spark):
    from datetime import datetime

    from ingestkit.operators import drift

    days = [
        ['{"a": 1, "b": {"x y": [1, 2], "q": {"z": null}}}', '{"a": 2}', "broken", None],
        ['{"a": "t", "b": {"x y": [{"p`": true}]}}'],
        ["not json"],
        ['{"a": "t", "b": {"x y": [{"p`": true}]}, "c": 1.25}', '{"a": 1}', '{"c": 10.5}'],
        ["[1]"],
    ]
    rows = [(datetime(2024, 1, i + 1, 5), j) for i, d in enumerate(days) for j in d]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, j string")
    got = [(r.period.day, r.previous_period.day, r.path, r.change, r.previous_type, r.new_type) for r in drift.json_path_drift(df, "j", "ts").collect()]
    assert got == [
        (2, 1, "$.a", "RETYPED", "BIGINT", "STRING"),
        (2, 1, "$.b.q", "DROPPED", "OBJECT", None),
        (2, 1, "$.b.q.z", "DROPPED", "VOID", None),
        (2, 1, "$.b.x y[]", "RETYPED", "BIGINT", "OBJECT"),
        (2, 1, "$.b.x y[].p`", "ADDED", None, "BOOLEAN"),
        (4, 2, "$.a", "RETYPED", "STRING", "VARIANT"),
        (4, 2, "$.c", "ADDED", None, "DECIMAL"),
        (5, 4, "$", "RETYPED", "OBJECT", "ARRAY"),
        (5, 4, "$.a", "DROPPED", "VARIANT", None),
        (5, 4, "$.b", "DROPPED", "OBJECT", None),
        (5, 4, "$.b.x y", "DROPPED", "ARRAY", None),
        (5, 4, "$.b.x y[]", "DROPPED", "OBJECT", None),
        (5, 4, "$.b.x y[].p`", "DROPPED", "BOOLEAN", None),
        (5, 4, "$.c", "DROPPED", "DECIMAL", None),
        (5, 4, "$[]", "ADDED", None, "BIGINT"),
    ]
    assert drift.json_path_drift(df.limit(0), "j", "ts").count() == 0


def test_closure_writes_each_pair_once(spark):
    """a round writes and shuffles its new pairs, not all pairs again."""
    from ingestkit.session import folders, work_root

    root = work_root(spark)
    before = set(folders(spark, root))
    edges = [(f"t{i:03d}", f"t{i + 1:03d}") for i in range(40)] + [("x", "y"), ("y", "z"), ("z", "x")]
    n = lineage.closure(spark.createDataFrame(edges, "source_table string, target_table string")).count()
    made = [f for f in folders(spark, root) if f.startswith("closure-") and f not in before]
    rows = sum(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/{f}/{d}").count()
               for f in made for d in ([x for x in folders(spark, f"{root}/{f}") if x.startswith("pairs-")] or ["."]))
    assert n == 40 * 41 // 2 + 9 and rows == n

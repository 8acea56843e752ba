import json

from pyspark.sql import functions as F

from ingestkit.sources import files as S
from ingestkit.sources import kafka as K

SF = "/root/testdata/sf0.001"


def test_csv_with_options_and_glob(spark, scratch):
    cust = spark.read.parquet(f"{SF}/customer.parquet")
    land = scratch("csv")
    cust.write.option("header", "true").option("delimiter", ";").csv(land)
    cust.write.mode("append").json(land)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cust.schema.fields)
    got = S.read_files(spark, land, "csv", {"header": "true", "delimiter": ";"}, schema=ddl, file_pattern="*.csv")
    assert sorted(got.collect()) == sorted(cust.collect())


def test_json_arrays_multiline(spark, scratch):
    part = spark.read.parquet(f"{SF}/part.parquet").repartition(3)
    land = scratch("json")
    S.write_json_arrays(part, land)
    got = S.read_files(spark, land, "json", {"multiLine": "true"}, schema=part.schema)
    assert sorted(got.collect()) == sorted(part.collect())


def test_incremental_filter_is_pushed_down(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    df = S.incremental_filter(orders, "o_orderdate", "1998-01-01 00:00:00", lookback_seconds=300)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in plan
    assert df.where(F.col("o_orderdate") <= F.lit("1997-12-31 23:55:00").cast("timestamp_ntz")).count() == 0


def test_envelope_parse_marks_corrupt_rows(spark):
    payloads = [json.dumps({"id": 1, "name": "a"}), json.dumps({"id": 2}), json.dumps({"id": 3, "name": "c", "extra": 1}), "{broken"]
    env = spark.createDataFrame([(p.encode(), i) for i, p in enumerate(payloads)], "value binary, offset bigint").select(
        F.lit(None).cast("binary").alias("key"), "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))
    out = {r.offset: r for r in K.parse_json_envelope(env, "id bigint, name string").collect()}
    assert (out[0].id, out[0].name, out[0]._corrupt_record) == (1, "a", None)
    assert (out[1].id, out[1].name, out[1]._corrupt_record) == (2, None, None)
    assert (out[2].id, out[2]._corrupt_record) == (3, None)
    assert out[3].id is None and out[3]._corrupt_record == "{broken"


def test_probe_and_masking(spark):
    from ingestkit.sources import probe

    readers = {
        "customer": lambda: spark.read.parquet(f"{SF}/customer.parquet"),
        "empty": lambda: spark.read.parquet(f"{SF}/customer.parquet").where("false"),
        "missing": lambda: spark.read.parquet(f"{SF}/no_such_table.parquet"),
    }
    out = {r.source_name: r for r in probe.probe(spark, readers, {"customer": {"user": "u", "password": "p"}}).collect()}
    assert (out["customer"].reachable, out["customer"].n_columns, out["customer"].has_rows) == (True, 5, True)
    assert out["customer"].options == "password=***, user=u"
    assert (out["empty"].reachable, out["empty"].has_rows) == (True, False)
    assert out["missing"].reachable is False and out["missing"].error
    masked = spark.createDataFrame([("user=a password=secret1;x",)], "t string").select(probe.mask_text(F.col("t"))).first()[0]
    assert masked == "user=a password=***;x"


def test_route_by_type(spark, scratch):
    import pytest

    from ingestkit.sources.route import read_source
    from ingestkit.spec import ResolvedTable, SourceSpec, TableSpec

    cust = spark.read.parquet(f"{SF}/customer.parquet")
    t = ResolvedTable(SourceSpec("files", "file", {"path": f"{SF}/customer.parquet"}), TableSpec("customer", format="parquet"))
    assert read_source(spark, t).count() == cust.count()
    bad = ResolvedTable(SourceSpec("x", "api"), TableSpec("t"))
    with pytest.raises(ValueError):
        read_source(spark, bad)


def test_rest_pages_template(spark, scratch):
    from ingestkit.sources import rest

    part = spark.read.parquet(f"{SF}/part.parquet")
    land = scratch("pages")
    part.coalesce(1).write.json(land)
    (page,) = spark.read.text(land).inputFiles()
    got = rest.read_rest(spark, part.schema, urls=page)
    assert sorted(got.collect()) == sorted(part.collect())


def test_layer_views(spark):
    from ingestkit.operators import scd
    from ingestkit.sources.route import current_or_base, read_layer, register_views

    log = spark.read.parquet(f"{SF}/orders.parquet").selectExpr(
        "o_custkey AS k", "o_orderstatus AS s", "o_orderdate AS ts", "o_orderkey AS seq")
    hist = scd.scd2_history(log, ["k"], ["s"], ["ts", "seq"])
    register_views(hist, "silver_test_customers")
    assert read_layer(spark, "silver_test_customers_history").count() == hist.count()
    assert current_or_base(spark, "silver_test_customers").count() == log.select("k").distinct().count()
    log.createOrReplaceTempView("silver_test_orders")
    assert current_or_base(spark, "silver_test_orders").count() == log.count()


def test_jdbc_parts_of_equal_size_give_every_row_once(spark):
    """A skewed column with a hot value, nulls and rows above the last end."""
    from ingestkit.sources import jdbc

    rows = [(i, None if i % 50 == 0 else 7 if i % 3 == 0 else (i * i) % 1000) for i in range(1200)]
    rows += [(None, 7), (-5, 7), (5000, 10_000_000)]
    spark.createDataFrame(rows, "id bigint, c bigint").createOrReplaceTempView("split_source")
    ends = [r.c for r in spark.sql(jdbc.depth_query("split_source", "c", 12)).collect()]
    assert len(ends) == 12 and ends.count(7) >= 3
    spark.createDataFrame([*rows, (6000, 99_000_000)], "id bigint, c bigint").createOrReplaceTempView("split_source")
    for tie in ("id", None):
        where = jdbc.depth_predicates("c", ends, tie)
        parts = [spark.sql(f"SELECT * FROM split_source WHERE {w}").collect() for w in where]
        assert sorted(map(repr, (r for p in parts for r in p))) == sorted(map(repr, spark.table("split_source").collect()))
        if tie:
            assert max(map(len, parts)) < len(rows) / 12 * 2
    assert jdbc.depth_predicates("c", [], None) == ["c IS NOT NULL", "c IS NULL"]
    assert jdbc.depth_predicates("d", ["2024-01-01", "it's"])[1] == "d > '2024-01-01' AND d <= 'it''s'"


def test_rest_cursor_goes_on_after_a_restart(spark, scratch, tmp_path):
    """Pages that name the next one inside; pages read before a restart may be gone by then."""
    import json
    import os

    from ingestkit.sources import rest
    from ingestkit.streaming import ingest as T

    land = tmp_path
    state, out, ckpt = (scratch(n) for n in ("state", "out", "ckpt"))

    def page(i, more):
        body = {"records": [{"id": 10 * i + k, "at": "2024-01-01T00:00:00"} for k in range(3)], "links": {"next": f"file://{land}/{i + 1}.json" if more else None}}
        with open(f"{land}/{i}.json", "w") as f:
            json.dump(body, f)

    def run(name, **kw):
        sink, _ = T.bronze_sink(out, name="rest")
        stream = rest.stream_rest(spark, "id bigint, at timestamp_ntz", url=f"file://{land}/0.json", nextPath="links.next",
                                  stateDir=state, pagesPerPartition=2, **kw)
        T.run_available_now(stream, ckpt, sink, name)
        return sorted(r.id for r in T.read_bronze(spark, out).collect())

    def ids(n):
        return [10 * i + k for i in range(n) for k in range(3)]

    for i in range(5):
        page(i, i < 4)
    assert run("rest_1", maxPages=3) == ids(3)  # a trigger takes so many pages at most
    assert run("rest_2") == ids(5)
    assert run("rest_3") == ids(5)  # nothing new
    for i in range(4):
        os.unlink(f"{land}/{i}.json")
    page(4, True)
    page(5, True)
    page(6, False)
    assert run("rest_4") == ids(7)


def test_registry_frames_come_off(spark):
    from ingestkit.sources import kafka

    rows = [(b"\x00\x00\x00\x01\x02payload",), (b"\x00\x7f\xff\xff\xff",), (b"plain",), (b"\x00\x01",), (None,), (b"",)]
    got = [(r.schema_id, r.value and bytes(r.value)) for r in kafka.unframed(spark.createDataFrame(rows, "value binary")).collect()]
    assert got == [(258, b"payload"), (2**31 - 1, b""), (None, b"plain"), (None, b"\x00\x01"), (None, None), (None, b"")]

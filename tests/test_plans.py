"""Plan checks: one shuffle where one suffices, filters at the scan, no Python on hot paths."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
PYTHON_SOURCES = {"src_rest_paged"}  # the paged REST reader is a Python data source by design


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scd2_history_is_one_shuffle(spark):
    p = plan(entry.queries()["scd2_history"](spark, SF))
    assert p.count("Exchange") == 1 and p.count("Window") == 2


def test_rules_reach_the_scan(spark):
    p = plan(entry.queries()["dq_drop"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_acctbal), IsNotNull(c_nationkey), GreaterThan(c_acctbal,0.0)" in p


def test_projection_reaches_the_scan(spark):
    p = plan(entry.queries()["gold_daily_orders"](spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p


def test_top_k_report(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["audit_history"](spark, SF))


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - PYTHON_SOURCES))
def test_no_python_in_plan(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert not any(n in p for n in PYTHON_NODES), name


def test_scd1_reuses_the_deduplicated_batch(spark):
    df = entry.queries()["scd1"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_as_of_join_is_not_a_range_join(spark):
    p = plan(entry.queries()["scd2_as_of_join"](spark, SF))
    assert "Join" not in p and "Window" in p

import pytest
from pyspark.sql import functions as F

from ingestkit.functions import rules as R
from ingestkit.operators import quality
from ingestkit.spec import Rule

ROWS = [(1, None, "a@b.co"), (2, 0.0, "a@b"), (3, -1.0, ""), (4, 5.0, None), (5, 2.0, "x.y@mail.example.org")]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "id int, amount double, email string")


def test_drop_and_quarantine_partition_the_input(df):
    rules = [R.positive("amount", severity="error"), R.valid_email("email")]
    good = {r.id for r in quality.drop_failing(df, rules).collect()}
    bad = quality.quarantine(df, rules, "b1", "2024-01-01 00:00:00").collect()
    assert good == {5}
    assert len(bad) == 4 and len(good) + len(bad) == df.count()
    reasons = {r.record_data: r.failed_rules for r in bad}
    assert any(v == "positive_value__amount" for v in reasons.values())  # row 1: NULL amount, valid e-mail
    assert all(r.batch_id == "b1" for r in bad)


def test_null_semantics_error_vs_warn(df):
    m = {r.rule_name: r for r in quality.rule_metrics(df, [R.positive("amount", "error", "e"), R.positive("amount", "warn", "w")]).collect()}
    # error: NULL does not pass; warn: NULL is not counted as a failure
    assert (m["e"].records_passed, m["e"].records_failed) == (2, 3)
    assert (m["w"].records_passed, m["w"].records_failed) == (3, 2)
    for r in m.values():
        assert r.records_passed + r.records_failed == r.records_checked == 5
    assert m["e"].is_quarantined and not m["w"].is_quarantined
    assert m["e"].failure_percentage == pytest.approx(60.0)


def test_metrics_on_empty_input(spark):
    empty = spark.createDataFrame([], "amount double")
    r = quality.rule_metrics(empty, [R.positive("amount")]).first()
    assert r.records_checked == 0 and r.failure_percentage == 0.0


def test_enforce_raises_on_bad_copy(spark, df):
    rules = [Rule("id_present", "id IS NOT NULL")]
    assert quality.enforce(df, rules).count() == 5
    bad = df.unionByName(spark.createDataFrame([(None, 1.0, "a@b.co")], df.schema))
    with pytest.raises(Exception, match="id_present"):
        quality.enforce(bad, rules).collect()


def test_duplicate_keys(spark):
    d = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "k int, n int")
    assert [tuple(r) for r in quality.duplicate_keys(d, ["k", "n"]).collect()] == [(1, 1, 2)]


def test_email_rule(df):
    ok = {r.id for r in df.where(F.coalesce(F.expr(R.valid_email("email").condition), F.lit(False))).collect()}
    assert ok == {1, 5}

"""Configuration and option builders (no Spark needed)."""

import pytest

from ingestkit.functions import rules as R
from ingestkit.sources import files, jdbc, kafka
from ingestkit.spec import Rule, SourceSpec, TableSpec, new_batch_id, resolve


def test_source_type_checked():
    SourceSpec("crm", "jdbc")
    with pytest.raises(ValueError):
        SourceSpec("crm", "unknown_type")


def test_table_defaults_and_checks():
    t = TableSpec("customers", source_table="public.customers", primary_key="customer_id", scd_type="scd2")
    assert t.primary_key == ("customer_id",)
    assert t.scd_type == "SCD2"
    assert t.origin == "public.customers"
    assert TableSpec("x").scd_type == "APPEND"
    with pytest.raises(ValueError):
        TableSpec("x", load_type="sometimes")
    with pytest.raises(ValueError):
        TableSpec("x", scd_type="SCD9")


def test_incremental_needs_column_except_files():
    with pytest.raises(ValueError):
        resolve(SourceSpec("db", "jdbc"), TableSpec("t", load_type="incremental"))
    resolve(SourceSpec("files", "cloud_storage"), TableSpec("t", load_type="incremental"))


def test_batch_id_format():
    b = new_batch_id()
    assert b.startswith("batch_") and len(b.split("_")[-1]) == 8


def test_rule_template_expansion():
    rs = R.expand([Rule("not_null", "{col} IS NOT NULL", "error", ("a", "b c"))])
    assert [r.name for r in rs] == ["not_null__a", "not_null__b c"]
    assert rs[1].condition == "`b c` IS NOT NULL"
    with pytest.raises(ValueError):
        Rule("r", "{col} > 0")
    with pytest.raises(ValueError):
        Rule("r", "a > 0", severity="fatal")
    assert Rule("r", "a > 0", severity="WARN").severity == "warn"


def test_default_rules():
    rs = R.default_rules({"not_null": ["id"], "valid_email": ["email"]})
    assert {r.name for r in rs} == {"not_null__id", "valid_email__email"}


def test_jdbc_urls():
    assert jdbc.jdbc_url("postgresql", "h", None, "db") == "jdbc:postgresql://h:5432/db"
    assert jdbc.jdbc_url("sqlserver", "h", 1433, "db") == "jdbc:sqlserver://h:1433;databaseName=db"
    assert jdbc.jdbc_url("mysql", "h", None, "db") == "jdbc:mysql://h:3306/db"
    with pytest.raises(ValueError):
        jdbc.jdbc_url("invalid_type")


def test_jdbc_options_partitioned():
    o = jdbc.jdbc_options({"host": "h", "database": "d", "driver_type": "postgresql"}, {"username": "u", "password": "p"},
                          table="public.t", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4)
    assert o["numPartitions"] == "4" and o["partitionColumn"] == "id" and o["user"] == "u"
    with pytest.raises(ValueError):
        jdbc.jdbc_options({}, table="t", partition_column="id")
    with pytest.raises(ValueError):
        jdbc.jdbc_options({}, table="t", query="select 1")


def test_kafka_sasl_options():
    plain = kafka.kafka_options({"bootstrap_servers": "b:9092"}, "topic")
    assert "kafka.sasl.jaas.config" not in plain and plain["startingOffsets"] == "latest"
    sasl = kafka.kafka_options({"bootstrap_servers": "b:9092", "security_protocol": "SASL_SSL", "sasl_mechanism": "PLAIN",
                                "username": "u", "password": "p"}, "topic", "earliest")
    assert sasl["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="u"' in sasl["kafka.sasl.jaas.config"]


def test_storage_uris():
    assert files.storage_uri("s3", bucket="b", path="/x/y") == "s3a://b/x/y"
    assert files.storage_uri("gcs", bucket="b", path="x") == "gs://b/x"
    assert files.storage_uri("azure", container="c", account="a", path="p").startswith("abfss://c@a.dfs.core.windows.net/")
    with pytest.raises(ValueError):
        files.storage_uri("ftp", path="x")
    assert len(files.azure_oauth_options("a", "id", "secret", "tenant")) == 5

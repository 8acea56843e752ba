"""Source routing (S20) and upstream-layer reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..spec import ResolvedTable
from . import files, jdbc, kafka, rest


def _storage_options(table: ResolvedTable) -> dict[str, str]:
    """OAuth settings of the source's storage account, when its credentials hold a client."""
    conn, creds = table.source.connection, table.source.credentials
    account = conn.get("account", conn.get("storage_account"))
    if account is None or "client_id" not in creds:
        return {}
    return files.azure_oauth_options(account, creds["client_id"], creds["client_secret"], creds["tenant_id"])


def read_source(spark: SparkSession, table: ResolvedTable, watermark=None, schema=None) -> DataFrame:
    """The reader for the source type: jdbc, kafka, cloud_storage, file or api."""
    kind, spec, conn = table.source.type, table.table, table.source.connection
    if kind == "jdbc":
        return jdbc.read_jdbc(spark, table, watermark)
    if kind == "kafka":
        if schema is None:
            raise ValueError("a Kafka table needs a payload schema")
        extra = {k: v for k, v in spec.options.items() if k != "startingOffsets"}
        env = kafka.read_kafka_stream(
            spark, {**conn, **table.source.credentials}, spec.topic, spec.options.get("startingOffsets", "latest"), extra
        )
        return kafka.parse_json_envelope(env, schema)
    if kind in ("cloud_storage", "file"):
        path = spec.path or conn.get("path")
        if conn.get("storage_type") and conn.get("storage_type") != "file" and "://" not in path:
            path = files.storage_uri(conn["storage_type"], **{"account": conn.get("storage_account"), **conn, "path": path})
        fmt = spec.format or "csv"
        options = {**_storage_options(table), **spec.options}
        if spec.load_type == "streaming" or (spec.load_type == "incremental" and not spec.incremental_column):
            return files.stream_files(spark, path, schema, fmt, options, file_pattern=spec.file_pattern)
        df = files.read_files(spark, path, fmt, options, schema, spec.file_pattern)
        if spec.incremental_column:
            df = files.incremental_filter(df, spec.incremental_column, watermark, spec.watermark_seconds)
        return df
    if kind == "api":
        if schema is None:
            raise ValueError("an API table needs a schema")
        opts = {**conn.get("options", {}), **spec.options}
        if watermark is not None:
            opts["since"] = str(watermark)
        df = rest.read_rest(spark, schema, **opts)
        if spec.incremental_column:
            df = files.incremental_filter(df, spec.incremental_column, watermark, spec.watermark_seconds)
        return df
    raise ValueError(f"unsupported source type {kind!r}")


def read_layer(spark: SparkSession, name: str) -> DataFrame:
    """An upstream layer registered as a table or view."""
    return spark.table(name)


def current_or_base(spark: SparkSession, name: str) -> DataFrame:
    """``<name>_current`` when it exists, else ``<name>``."""
    cur = f"{name}_current"
    return spark.table(cur) if spark.catalog.tableExists(cur) else spark.table(name)


def register_views(history: DataFrame, name: str) -> None:
    """K4 / K5: ``<name>_current`` (open versions) and ``<name>_history`` (all versions)."""
    history.createOrReplaceTempView(f"{name}_history")
    history.where("_scd_is_current").createOrReplaceTempView(f"{name}_current")

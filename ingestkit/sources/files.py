"""File and object-storage sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import minus_seconds, ts_literal

# URI forms per storage provider.
STORAGE_URI = {
    "azure": "abfss://{container}@{account}.dfs.core.windows.net/{path}",
    "s3": "s3a://{bucket}/{path}",
    "gcs": "gs://{bucket}/{path}",
    "file": "file://{path}",
}


def storage_uri(kind: str, **parts) -> str:
    """The URI of ``path`` on the given provider."""
    if kind not in STORAGE_URI:
        raise ValueError(f"unsupported storage type {kind!r}; expected one of {sorted(STORAGE_URI)}")
    parts = {**parts, "path": str(parts.get("path", "")).lstrip("/") if kind != "file" else parts.get("path", "")}
    return STORAGE_URI[kind].format(**parts)


def azure_oauth_options(account: str, client_id: str, client_secret: str, tenant_id: str) -> dict[str, str]:
    """OAuth settings for one storage account, given per read (not session state)."""
    host = f"{account}.dfs.core.windows.net"
    return {
        f"fs.azure.account.auth.type.{host}": "OAuth",
        f"fs.azure.account.oauth.provider.type.{host}": "org.apache.hadoop.fs.azurebfs.oauth2.ClientCredsTokenProvider",
        f"fs.azure.account.oauth2.client.id.{host}": client_id,
        f"fs.azure.account.oauth2.client.secret.{host}": client_secret,
        f"fs.azure.account.oauth2.client.endpoint.{host}": f"https://login.microsoftonline.com/{tenant_id}/oauth2/token",
    }


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    options: dict | None = None,
    schema: StructType | str | None = None,
    file_pattern: str | None = None,
) -> DataFrame:
    """Read a folder of csv / json / parquet / orc / text files.

    ``file_pattern`` filters file names (``pathGlobFilter``); csv options such as
    header, delimiter and inferSchema and json's multiLine pass through. An
    explicit schema avoids the extra pass that inference costs.
    """
    opts = dict(options or {})
    fmt = opts.pop("format", fmt)
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in opts.items()})
    if file_pattern and file_pattern != "*":
        reader = reader.option("pathGlobFilter", file_pattern)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def incremental_filter(df: DataFrame, column: str, watermark: str | datetime | None, lookback_seconds: int = 0) -> DataFrame:
    """F1 / F2: rows strictly newer than the watermark minus the look-back buffer.

    Written as a plain comparison with a literal, so it reaches the scan as a
    pushed filter (parquet row groups, or the JDBC WHERE clause).
    """
    if watermark is None:
        return df
    bound = ts_literal(watermark)
    if lookback_seconds:
        bound = minus_seconds(bound, lookback_seconds)
    return df.where(F.col(column) > bound)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    options: dict | None = None,
    max_files_per_trigger: int | None = None,
    file_pattern: str | None = None,
) -> DataFrame:
    """A folder as a stream; with a checkpoint, each run reads only new files."""
    reader = spark.readStream.format(fmt).schema(schema).options(**{k: str(v) for k, v in (options or {}).items()})
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Land rows as multi-line JSON files: each output file holds one JSON array.

    Spark renders each row as JSON; a per-partition step only adds the brackets
    and commas, streaming through the partition in Arrow batches.
    """
    from ..sources.kafka import JSON_TS

    lines = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_TS).alias("value"))

    def frame(batches):
        import pandas as pd

        pending, first = None, True
        for pdf in batches:
            vals = pdf["value"].tolist()
            if not vals:
                continue
            if pending is not None:
                vals.insert(0, pending)
            pending = vals.pop()
            if vals:
                out = [("[" if first and i == 0 else ",") + v for i, v in enumerate(vals)]
                first = False
                yield pd.DataFrame({"value": out})
        if pending is not None:
            yield pd.DataFrame({"value": [("[" if first else ",") + pending + "]"]})

    lines.mapInPandas(frame, "value string").write.text(path)

"""Kafka sources (S5-S7, E8): options and the envelope parse.

The parse works on any frame with Kafka's envelope columns (key, value, topic,
partition, offset, timestamp), whether it comes from ``readStream.format("kafka")``
or from files holding the same envelope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed value: the envelope schema of Spark's Kafka source.
ENVELOPE_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)
CORRUPT = "_corrupt_record"
# Fixed value: JSON timestamp text keeps microseconds.
JSON_TS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def kafka_options(connection: dict, topic: str, starting_offsets: str = "latest", extra: dict | None = None) -> dict[str, str]:
    """Subscription and SASL settings (JAAS line when the protocol is not PLAINTEXT).

    Lost offsets fail the stream, as is Spark's default; ``extra`` may set ``failOnDataLoss``."""
    opts = {
        "kafka.bootstrap.servers": connection["bootstrap_servers"],
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    protocol = connection.get("security_protocol", "PLAINTEXT")
    if protocol != "PLAINTEXT":
        mechanism = connection.get("sasl_mechanism", "PLAIN")
        user, password = connection.get("username", ""), connection.get("password", "")
        module = (
            "org.apache.kafka.common.security.scram.ScramLoginModule"
            if mechanism.startswith("SCRAM")
            else "org.apache.kafka.common.security.plain.PlainLoginModule"
        )
        opts.update(
            {
                "kafka.security.protocol": protocol,
                "kafka.sasl.mechanism": mechanism,
                "kafka.sasl.jaas.config": f'{module} required username="{user}" password="{password}";',
            }
        )
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def read_kafka_stream(
    spark: SparkSession, connection: dict, topic: str, starting_offsets: str = "latest", extra: dict | None = None
) -> DataFrame:
    """Needs the spark-sql-kafka package on the cluster."""
    return spark.readStream.format("kafka").options(**kafka_options(connection, topic, starting_offsets, extra)).load()


def parse_json_envelope(envelope: DataFrame, schema: StructType | str, keep_corrupt: bool = True) -> DataFrame:
    """Payload fields plus kafka_timestamp (and topic / partition / offset).

    Rows whose payload is not valid JSON keep NULL fields and carry the raw text
    in ``_corrupt_record`` so a quality rule can send them to quarantine.
    """
    text = F.col("value").cast("string")
    opts = {"mode": "PERMISSIVE", **JSON_TS}
    parsed = F.from_json(text, schema, opts).alias("data")
    out = envelope.select(
        parsed,
        F.col("timestamp").alias("kafka_timestamp"),
        "topic",
        "partition",
        "offset",
        text.alias("_raw"),
    )
    fields = [f"data.{f}" for f in out.schema["data"].dataType.fieldNames()]
    cols = [F.col(f) for f in fields] + ["kafka_timestamp", "topic", "partition", "offset"]
    if keep_corrupt:
        bad = F.col("data").isNull() | F.try_parse_json(F.col("_raw")).isNull()
        cols.append(F.when(bad, F.col("_raw")).alias(CORRUPT))
    return out.select(*cols)


def to_envelope(df: DataFrame, topic: str, key: str, ts: str) -> DataFrame:
    """Rows as Kafka envelopes (value = JSON of the row), e.g. to land a table as a topic dump."""
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_TS).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col(key).cast("bigint").alias("offset"),
        F.col(ts).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def unframed(envelope: DataFrame) -> DataFrame:
    """Envelopes whose payload a schema registry framed (a zero byte, the schema's number in four bytes,
    then the Avro bytes) with the bare payload as ``value`` and the number as ``schema_id``; a payload without
    the frame keeps its bytes and has no number."""
    value = F.col("value")
    framed = (F.octet_length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00")
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
    bare = F.expr("substring(value, 6)")
    return envelope.withColumns({"schema_id": F.when(framed, number), "value": F.when(framed, bare).otherwise(value)})


def parse_registry_envelope(envelope: DataFrame, schemas: dict[int, str], reader_schema: str) -> DataFrame:
    """Framed Avro payloads, each read by the schema that its number names and resolved to
    ``reader_schema``; numbers that ``schemas`` lacks go as raw bytes to ``_unknown_payload``. Needs spark-avro."""
    from pyspark.sql.avro.functions import from_avro

    rows = unframed(envelope)
    options = {"mode": "PERMISSIVE", "avroSchema": reader_schema}
    data = F.coalesce(*[F.when(F.col("schema_id") == i, from_avro(F.col("value"), text, options)) for i, text in schemas.items()])
    unknown = ~F.coalesce(F.col("schema_id").isin(*schemas), F.lit(False))
    out = rows.select(
        data.alias("data"), F.col("timestamp").alias("kafka_timestamp"), "topic", "partition", "offset", "schema_id",
        F.when(unknown, F.col("value")).alias("_unknown_payload"),
    )
    return out.select("data.*", "kafka_timestamp", "topic", "partition", "offset", "schema_id", "_unknown_payload")


def parse_avro_envelope(envelope: DataFrame, avro_schema_json: str) -> DataFrame:
    """Avro payloads (plain Avro, no registry framing). Needs the spark-avro package
    on the cluster; without it Spark reports the missing data source when the plan is analysed."""
    from pyspark.sql.avro.functions import from_avro

    out = envelope.select(
        from_avro(F.col("value"), avro_schema_json, {"mode": "PERMISSIVE"}).alias("data"),
        F.col("timestamp").alias("kafka_timestamp"),
        "topic",
        "partition",
        "offset",
    )
    return out.select("data.*", "kafka_timestamp", "topic", "partition", "offset")

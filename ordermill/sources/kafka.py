"""Kafka: source options, the message envelope, order payloads in both directions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.payload import ORDER_PAYLOAD, encode_row

ENVELOPE = "key binary, value binary, timestamp timestamp, partition int, offset bigint"


def source_options(
    servers: str,
    topic: str,
    max_offsets: int | None = None,
    security: Mapping[str, str] | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Read a topic from its start, stopping with an error when unread messages have expired.

    `max_offsets` bounds a micro-batch; without it a batch takes all there is. `security` holds kafka.* options such as kafka.security.protocol and kafka.sasl.jaas.config.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **({} if max_offsets is None else {"maxOffsetsPerTrigger": str(max_offsets)}),
        **(security or {}),
    }


def scram_security(user: str, password: str, truststore: str, login_module: str) -> dict[str, str]:
    """SASL_SSL with SCRAM. Platforms that shade the Kafka client use their own login module name."""
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-256",
        "kafka.sasl.jaas.config": f'{login_module} required username="{user}" password="{password}";',
        "kafka.ssl.truststore.type": "PEM",
        "kafka.ssl.truststore.location": truststore,
    }


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def decode_envelope(messages: DataFrame) -> DataFrame:
    return messages.selectExpr(
        "CAST(key AS STRING) AS kafka_key",
        "CAST(value AS STRING) AS raw_json_payload",
        "timestamp AS kafka_timestamp",
        "partition",
        "offset",
    )


def parse_payload(decoded: DataFrame, schema: T.StructType = ORDER_PAYLOAD) -> DataFrame:
    """Payload fields next to the raw text; a message that is no JSON keeps its text and NULL fields."""
    parsed = decoded.withColumn("data", F.from_json("raw_json_payload", schema))
    return parsed.select("kafka_key", "raw_json_payload", "data.*", "kafka_timestamp", "partition", "offset")


def bronze_orders(messages: DataFrame, schema: T.StructType = ORDER_PAYLOAD) -> DataFrame:
    """Envelope to bronze rows, stamped with the ingestion time. Works on batches and streams."""
    return parse_payload(decode_envelope(messages), schema).withColumn("ingested_at", F.current_timestamp())


def to_messages(df: DataFrame, key: str | Column, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as JSON messages keyed by entity, so that one entity keeps its order on one partition."""
    k = F.col(key) if isinstance(key, str) else key
    return df.select(k.cast("string").alias("key"), encode_row(*(columns or df.columns)).alias("value"))


def publish(messages: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None) -> None:
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    writer.options(**(options or {})).save()

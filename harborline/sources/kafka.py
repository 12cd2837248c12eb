"""Kafka: options of the reader, and records as messages. The connector's jar must be on the class path to read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def options(
    servers: str, topics: list[str], group: str, protocol: str = "SASL_SSL", mechanism: str = "PLAIN", username: str | None = None, password: str | None = None, offset_reset: str = "earliest", credentials: Callable[[], dict] | None = None
) -> dict[str, str]:
    """Reader options; security ones only where the protocol isn't PLAINTEXT, a login only for PLAIN with both parts.

    credentials: called for {"username", "password"}, in place of a secret store.
    """
    out = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "kafka.group.id": group, "startingOffsets": offset_reset, "failOnDataLoss": "false"}
    if credentials:
        given = credentials()
        username, password = given.get("username"), given.get("password")
    if protocol != "PLAINTEXT":
        out |= {"kafka.security.protocol": protocol, "kafka.sasl.mechanism": mechanism}
        if mechanism == "PLAIN" and username and password:
            out["kafka.sasl.jaas.config"] = f'org.apache.kafka.common.security.plain.PlainLoginModule required username="{username}" password="{password}";'
    return out


def read_stream(spark: SparkSession, **given) -> DataFrame:
    """Records as they arrive."""
    try:
        return spark.readStream.format("kafka").options(**options(**given)).load()
    except Exception as e:
        if "kafka" in str(e).lower():
            raise RuntimeError("the spark-sql-kafka package is not on the class path") from e
        raise


def to_messages(records: DataFrame) -> DataFrame:
    """Records (key, value, topic, partition, offset, timestamp) as (data, attributes); values that aren't JSON become {"raw_value": text}."""
    text = F.col("value").cast("string")
    body = F.when(F.try_parse_json(text).isNotNull(), text).otherwise(F.to_json(F.struct(text.alias("raw_value"))))
    known = F.create_map(
        F.lit("_kafka_topic"), "topic", F.lit("_kafka_partition"), F.col("partition").cast("string"), F.lit("_kafka_offset"), F.col("offset").cast("string"), F.lit("_kafka_timestamp"), F.col("timestamp").cast("string")
    )
    key = F.col("key").cast("string")
    keyed = F.when(F.length(key) > 0, F.map_concat(known, F.create_map(F.lit("_kafka_key"), key))).otherwise(known)
    return records.select(body.cast("binary").alias("data"), keyed.alias("attributes"))

"""Routing by domain and priority, filtering by type, rows for the dead letter table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.functions import envelope
from harborline.types import DOMAINS

# Event types of high and low priority
HIGH = ["shipment.created", "shipment.delivered", "delivery.completed", "delivery.failed"]
LOW = ["driver.location_updated"]


def with_route(df: DataFrame) -> DataFrame:
    """df with `route`: the domain, or other."""
    d = envelope.domain(F.col("event_type"))
    return df.withColumn("route", F.when(d.isin(DOMAINS), d).otherwise("other"))


def with_priority(df: DataFrame, high: list[str] | None = None) -> DataFrame:
    """df with `priority`: high, low or normal."""
    t = F.col("event_type")
    return df.withColumn("priority", F.when(t.isin(HIGH if high is None else high), "high").when(t.isin(LOW), "low").otherwise("normal"))


def only_types(df: DataFrame, allowed: list[str]) -> DataFrame:
    """Events of the allowed types; the filter reaches the scan."""
    return df.where(F.col("event_type").isin(list(allowed)))


def dead_letters(invalid: DataFrame) -> DataFrame:
    """(data, attributes) of invalid envelopes, with the time of arrival and the count of errors as attributes."""
    body = F.to_json(F.struct("event_id", "event_type", "event_version", "event_time", "ingest_time", "source_system", F.try_parse_json("payload").alias("payload"), "trace_id"), {"ignoreNullFields": "false"})
    attributes = F.create_map(
        F.lit("event_id"), "event_id", F.lit("event_type"), "event_type", F.lit("source_system"), "source_system",
        F.lit("failure_time"), F.date_format("ingest_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"), F.lit("validation_error_count"), F.size("errors").cast("string"),
    )
    return invalid.select(body.cast("binary").alias("data"), attributes.alias("attributes"))

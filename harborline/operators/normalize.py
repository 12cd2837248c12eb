"""Raw messages (data binary, attributes map) as envelopes, in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions import jsontext
from harborline.session import spread

# Names under which a message may carry an envelope field, in order
ALIASES = {
    "event_id": "event_id eventId id message_id messageId".split(),
    "event_type": "event_type eventType type".split(),
    "event_version": "event_version eventVersion version schema_version".split(),
    "event_time": "event_time eventTime timestamp created_at occurred_at".split(),
    "source_system": "source_system sourceSystem source origin".split(),
    "trace_id": "trace_id traceId x-trace-id X-Trace-Id correlation_id".split(),
}
#: Keys that are no payload when a body has no payload object of its own.
METADATA = [a for names in ALIASES.values() for a in names if a != "X-Trace-Id"]
_INFERRED = ["shipment", "facility", "driver", "delivery"]


def _text(v: Column) -> Column:
    """A variant as text: strings plain, all else as JSON."""
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))


def _present(body: Column, attributes: Column, names: list[str], default: Column) -> Column:
    """The first alias that is present, in the body before the attributes; JSON null counts and reads None."""
    out = F
    for n in names:
        given = F.when(F.is_variant_null(body[n]), "None").otherwise(_text(body[n]))
        out = out.when(body[n].isNotNull(), given).when(F.map_contains_key(attributes, n), F.coalesce(attributes[n], F.lit("None")))
    return out.otherwise(default)


def instant(text: Column, is_number: Column, fallback: Column) -> Column:
    """An ISO time or epoch seconds; what can't be read is the fallback."""
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.regexp_replace(text, "Z", "+00:00").try_cast("timestamp")).when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    seconds = F.when(is_number, F.timestamp_micros((text.try_cast("decimal(20,6)") * 1_000_000).try_cast("long")))
    return F.coalesce(F.when(is_number, seconds).otherwise(iso), fallback)


def normalize(messages: DataFrame, ingest_time: Column | None = None, new_id: Column | None = None) -> DataFrame:
    """Envelopes of messages. ingest_time and new_id (for messages without an identifier) can be given, for repeatability.

    A body that is no JSON object becomes {"raw_data": text}, bytes that aren't UTF-8 in hex; null bodies are empty texts.
    Further columns of the messages are dropped, whatever their names. The body is parsed once.
    """
    now = F.current_timestamp() if ingest_time is None else ingest_time
    new_id = F.uuid() if new_id is None else new_id
    attributes = F.coalesce(F.col("attributes"), F.create_map().cast("map<string,string>"))
    data = F.coalesce(F.col("data"), F.lit(b"")).cast("string")
    text = F.when(F.is_valid_utf8(data), data).otherwise(F.hex(F.col("data")))
    raw = jsontext.once(spread(messages).select(text.alias("_text"), attributes.alias("_attributes"), now.alias("ingest_time"), new_id.alias("_new")), "_object", F.from_json("_text", "map<string,variant>"))
    whole = F.from_json(F.to_json(F.struct(F.col("_text").alias("raw_data"))), "map<string,variant>")
    raw = raw.withColumn("_body", F.coalesce("_object", whole))
    b, a = F.col("_body"), F.col("_attributes")
    inferred = F
    for d in _INFERRED:
        inferred = inferred.when(b[f"{d}_id"].isNotNull() | b[f"{d}Id"].isNotNull(), f"{d}.unknown")
    truthy = lambda c: F.when(~c.isin("", "0", "0.0", "false", "{}", "[]"), c)
    number = lambda v: F.coalesce(jsontext.kind(v) == "number", F.lit(False))
    stated = [F.struct(truthy(_text(b[n])).alias("t"), number(b[n]).alias("k")) if m is b else F.struct(truthy(a[n]).alias("t"), F.lit(False).alias("k")) for n in ALIASES["event_time"] for m in (b, a)]
    object_at = lambda k: jsontext.kind(b[k]) == "object"
    rest = F.to_json(F.map_filter(b, lambda k, _: ~k.isin(METADATA)))
    payload = F.when(object_at("payload"), F.to_json(b["payload"])).when(object_at("data"), F.to_json(b["data"])).otherwise(rest)
    raw = raw.withColumn("_at", F.filter(F.array(*stated), lambda x: x["t"].isNotNull()))
    raw = raw.withColumn("_at", F.get("_at", F.lit(0)))
    return raw.select(
        _present(b, a, ALIASES["event_id"], F.col("_new")).alias("event_id"),
        _present(b, a, ALIASES["event_type"], inferred.otherwise("unknown")).alias("event_type"),
        _present(b, a, ALIASES["event_version"], F.lit("v1")).alias("event_version"),
        instant(F.col("_at.t"), F.coalesce(F.col("_at.k"), F.lit(False)), F.col("ingest_time")).alias("event_time"),
        "ingest_time",
        _present(b, a, ALIASES["source_system"], F.lit("unknown")).alias("source_system"),
        payload.alias("payload"),
        _present(b, a, ALIASES["trace_id"], F.lit(None).cast("string")).alias("trace_id"),
    )


def to_json_line(df: DataFrame) -> DataFrame:
    """Envelopes as (value): one JSON object each, times in ISO form."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(c)
    return df.select(F.to_json(F.struct("event_id", "event_type", "event_version", iso("event_time"), iso("ingest_time"), "source_system", F.try_parse_json("payload").alias("payload"), "trace_id"), {"ignoreNullFields": "false"}).alias("value"))


def from_json_line(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Envelopes from to_json_line(); missing keys get defaults."""
    now = F.current_timestamp() if now is None else now
    v = lambda p: jsontext.scalar(F.col("value"), f"$.{p}")
    time = lambda p: F.coalesce(F.regexp_replace(v(p), "Z", "+00:00").try_cast("timestamp"), now).alias(p)
    return df.select(
        F.coalesce(v("event_id"), F.lit("")).alias("event_id"), F.coalesce(v("event_type"), F.lit("unknown")).alias("event_type"), F.coalesce(v("event_version"), F.lit("v1")).alias("event_version"),
        time("event_time"), time("ingest_time"), F.coalesce(v("source_system"), F.lit("unknown")).alias("source_system"),
        F.coalesce(F.to_json(F.try_variant_get(F.try_parse_json("value"), "$.payload", "variant")), F.lit("{}")).alias("payload"), v("trace_id").alias("trace_id"),
    )

"""Schemas of envelopes, clean (silver) tables and curated (gold) tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _TS, _L, _D, _B, _DATE = T.StringType(), T.TimestampType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType()


REQUIRED, NULLABLE = False, True


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


# Columns of envelopes, clean and curated tables, domains, event types
ENVELOPE = _struct(
    ("event_id", _S, REQUIRED),
    ("event_type", _S, REQUIRED),
    ("event_version", _S, REQUIRED),
    ("event_time", _TS, REQUIRED),
    ("ingest_time", _TS, REQUIRED),
    ("source_system", _S, REQUIRED),
    ("payload", _S, NULLABLE),
    ("trace_id", _S, NULLABLE),
)
VALIDATION_ERRORS = "array<struct<field: string, message: string, error_code: string, value: string>>"
DOMAINS = ["shipment", "facility", "driver", "delivery"]

_COMMON = _struct(
    ("event_id", _S, REQUIRED),
    ("event_type", _S, REQUIRED),
    ("event_version", _S, REQUIRED),
    ("event_time", _TS, REQUIRED),
    ("ingest_time", _TS, REQUIRED),
    ("trace_id", _S, NULLABLE),
    ("source_system", _S, NULLABLE),
    ("payload", _S, NULLABLE),
    ("dedupe_key", _S, REQUIRED),
)
#: Columns that a domain's clean table has besides the common ones.
PROMOTED = {
    "shipment": ["shipment_id", "tracking_number", "carrier_id", "facility_id"],
    "facility": ["facility_id", "facility_type", "region_id"],
    "driver": ["driver_id", "carrier_id", "facility_id", "vehicle_id"],
    "delivery": ["delivery_id", "shipment_id", "driver_id", "facility_id"],
}

GOLD = {
    "fact_deliveries": _struct(
        ("delivery_id", _S, REQUIRED),
        ("shipment_id", _S, REQUIRED),
        ("delivery_date", _DATE, REQUIRED),
        ("facility_id", _S, NULLABLE),
        ("driver_id", _S, NULLABLE),
        ("carrier_id", _S, NULLABLE),
        ("status", _S, NULLABLE),
        ("scheduled_time", _TS, NULLABLE),
        ("delivery_time", _TS, NULLABLE),
        ("first_attempt_time", _TS, NULLABLE),
        ("attempt_count", _L, NULLABLE),
        ("on_time_flag", _B, NULLABLE),
        ("delivery_duration_minutes", _L, NULLABLE),
    ),
    "fact_shipment_events": _struct(
        ("event_id", _S, REQUIRED),
        ("shipment_id", _S, REQUIRED),
        ("event_date", _DATE, REQUIRED),
        ("event_type", _S, REQUIRED),
        ("event_time", _TS, REQUIRED),
        ("facility_id", _S, NULLABLE),
        ("carrier_id", _S, NULLABLE),
        ("driver_id", _S, NULLABLE),
        ("status", _S, NULLABLE),
        ("latitude", _D, NULLABLE),
        ("longitude", _D, NULLABLE),
    ),
    "dim_facility": _struct(
        ("facility_id", _S, REQUIRED),
        ("facility_name", _S, NULLABLE),
        ("facility_type", _S, NULLABLE),
        ("address", _S, NULLABLE),
        ("city", _S, NULLABLE),
        ("state", _S, NULLABLE),
        ("country", _S, NULLABLE),
        ("postal_code", _S, NULLABLE),
        ("latitude", _D, NULLABLE),
        ("longitude", _D, NULLABLE),
        ("timezone", _S, NULLABLE),
        ("capacity_units", _L, NULLABLE),
        ("is_active", _B, NULLABLE),
        ("effective_from", _TS, REQUIRED),
        ("effective_to", _TS, NULLABLE),
        ("is_current", _B, REQUIRED),
    ),
    "dim_carrier": _struct(
        ("carrier_id", _S, REQUIRED),
        ("carrier_name", _S, NULLABLE),
        ("carrier_type", _S, NULLABLE),
        ("scac_code", _S, NULLABLE),
        ("is_active", _B, NULLABLE),
        ("effective_from", _TS, REQUIRED),
        ("effective_to", _TS, NULLABLE),
        ("is_current", _B, REQUIRED),
    ),
    "dim_driver": _struct(
        ("driver_id", _S, REQUIRED),
        ("driver_name_hash", _S, NULLABLE),
        ("carrier_id", _S, NULLABLE),
        ("home_facility_id", _S, NULLABLE),
        ("license_type", _S, NULLABLE),
        ("is_active", _B, NULLABLE),
        ("effective_from", _TS, REQUIRED),
        ("effective_to", _TS, NULLABLE),
        ("is_current", _B, REQUIRED),
    ),
}

#: The twenty-one event types, by domain.
EVENT_TYPES = {
    "shipment": "created updated cancelled in_transit delivered returned".split(),
    "facility": "created updated capacity_changed status_changed".split(),
    "driver": "created updated assigned location_updated status_changed".split(),
    "delivery": "scheduled started attempted completed failed rescheduled".split(),
}


def event_types(domain: str | None = None) -> list[str]:
    """All event types, or those of a domain."""
    return [f"{d}.{a}" for d, actions in EVENT_TYPES.items() if domain in (None, d) for a in actions]


def silver(domain: str) -> T.StructType:
    """Schema of a domain's clean table; an unknown domain has the common columns only."""
    return T.StructType(_COMMON.fields + [T.StructField(c, _S, True) for c in PROMOTED.get(domain, [])])


def schema_string(domain: str) -> str:
    """The clean schema as 'name:TYPE,...' with warehouse type names."""
    names = {"string": "STRING", "timestamp": "TIMESTAMP", "bigint": "INT64", "double": "FLOAT64", "boolean": "BOOL", "date": "DATE"}
    return ",".join(f"{f.name}:{'JSON' if f.name == 'payload' else names[f.dataType.simpleString()]}" for f in silver(domain))

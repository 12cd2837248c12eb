"""Typed events as JSON Schemas, for the compiler in operators.validate."""

from __future__ import annotations

TEXT = {"type": "string"}
TIME = {"type": "string", "format": "date-time"}
FLAG = {"type": "boolean"}
INTEGER = {"type": "integer"}
NUMBER = {"type": "number"}
LIST = {"type": "array"}


def one_of(name: str) -> dict:
    """A text of a value list."""
    return {"enum": VALUES[name]}


def structure(name: str) -> dict:
    """A nested object."""
    return {"$ref": f"#/definitions/{name}"}


def required(node: dict) -> tuple[dict, bool]:
    """A field that must be there."""
    return node, True


def optional(node: dict) -> tuple[dict, bool]:
    """A field that may be absent, or null where it is of a plain type."""
    return (node | {"type": [node["type"], "null"]} if "type" in node else node), False


# The platform's value lists
VALUES = {
    "shipment_status": [
        "created",
        "label_printed",
        "picked_up",
        "in_transit",
        "out_for_delivery",
        "delivered",
        "delivery_attempted",
        "returned",
        "cancelled",
        "on_hold",
        "exception",
    ],
    "service_level": [
        "ground",
        "express",
        "overnight",
        "same_day",
        "economy",
        "freight",
    ],
    "failure_reason": [
        "recipient_not_home",
        "wrong_address",
        "access_issue",
        "refused",
        "damaged_package",
        "weather",
        "vehicle_issue",
        "driver_issue",
        "business_closed",
        "other",
    ],
    "delivery_location": [
        "front_door",
        "back_door",
        "side_door",
        "garage",
        "mailroom",
        "reception",
        "locker",
        "neighbor",
        "safe_place",
        "in_person",
    ],
    "driver_status": [
        "available",
        "on_route",
        "delivering",
        "on_break",
        "off_duty",
        "unavailable",
    ],
    "vehicle_type": [
        "van",
        "truck",
        "semi",
        "cargo_bike",
        "motorcycle",
        "car",
    ],
    "facility_type": [
        "warehouse",
        "distribution_center",
        "cross_dock",
        "last_mile_hub",
        "returns_center",
        "locker",
        "partner_location",
    ],
    "facility_status": [
        "active",
        "inactive",
        "maintenance",
        "closed",
        "capacity_limited",
    ],
}

# The platform's nested objects
STRUCTURES = {
    "address": {
        "street": required(TEXT),
        "city": required(TEXT),
        "state": required(TEXT),
        "postal_code": required(TEXT),
        "country": optional(TEXT),
        "latitude": optional(NUMBER),
        "longitude": optional(NUMBER),
    },
    "location": {
        "latitude": required(NUMBER | {"minimum": -90, "maximum": 90}),
        "longitude": required(NUMBER | {"minimum": -180, "maximum": 180}),
        "accuracy_meters": optional(NUMBER | {"minimum": 0}),
        "altitude_meters": optional(NUMBER),
        "heading": optional(NUMBER | {"minimum": 0, "exclusiveMaximum": 360}),
        "speed_mps": optional(NUMBER | {"minimum": 0}),
    },
    "contact": {
        "name": required(TEXT),
        "phone": optional(TEXT),
        "email": optional(TEXT),
    },
    "dimensions": {
        "length_cm": required(NUMBER | {"exclusiveMinimum": 0}),
        "width_cm": required(NUMBER | {"exclusiveMinimum": 0}),
        "height_cm": required(NUMBER | {"exclusiveMinimum": 0}),
        "weight_kg": required(NUMBER | {"exclusiveMinimum": 0}),
    },
}

# The fields of shipment events
SHIPMENT = {
    "shipment.created": {
        "shipment_id": required(TEXT),
        "tracking_number": required(TEXT),
        "carrier_id": required(TEXT),
        "service_level": required(one_of("service_level")),
        "origin_address": required(structure("address")),
        "destination_address": required(structure("address")),
        "sender": required(structure("contact")),
        "recipient": required(structure("contact")),
        "dimensions": optional(structure("dimensions")),
        "declared_value_cents": optional(INTEGER | {"minimum": 0}),
        "contents_description": optional(TEXT),
        "is_fragile": optional(FLAG),
        "requires_signature": optional(FLAG),
        "estimated_delivery_date": optional(TIME),
        "scheduled_pickup_time": optional(TIME),
        "order_id": optional(TEXT),
        "customer_id": optional(TEXT),
        "facility_id": optional(TEXT),
    },
    "shipment.updated": {
        "shipment_id": required(TEXT),
        "tracking_number": required(TEXT),
        "previous_status": optional(one_of("shipment_status")),
        "current_status": required(one_of("shipment_status")),
        "status_reason": optional(TEXT),
        "facility_id": optional(TEXT),
        "location_description": optional(TEXT),
        "estimated_delivery_date": optional(TIME),
        "exception_code": optional(TEXT),
        "exception_message": optional(TEXT),
    },
    "shipment.delivered": {
        "shipment_id": required(TEXT),
        "tracking_number": required(TEXT),
        "delivery_id": required(TEXT),
        "driver_id": optional(TEXT),
        "facility_id": optional(TEXT),
        "delivery_time": required(TIME),
        "delivery_location": optional(TEXT),
        "signed_by": optional(TEXT),
        "signature_required": optional(FLAG),
        "signature_obtained": optional(FLAG),
        "photo_url": optional(TEXT),
        "delivery_notes": optional(TEXT),
        "delivery_attempt_count": optional(INTEGER | {"minimum": 1}),
        "was_on_time": optional(FLAG),
    },
    "shipment.in_transit": {
        "shipment_id": required(TEXT),
        "tracking_number": required(TEXT),
        "carrier_id": required(TEXT),
        "current_facility_id": optional(TEXT),
        "next_facility_id": optional(TEXT),
        "current_location": optional(TEXT),
        "vehicle_id": optional(TEXT),
        "driver_id": optional(TEXT),
        "transport_mode": optional(TEXT),
        "departed_at": optional(TIME),
        "estimated_arrival": optional(TIME),
    },
    "shipment.cancelled": {
        "shipment_id": required(TEXT),
        "tracking_number": required(TEXT),
        "cancellation_reason": required(TEXT),
        "cancelled_by": required(TEXT),
        "refund_eligible": optional(FLAG),
        "previous_status": required(one_of("shipment_status")),
    },
}

# The fields of delivery events
DELIVERY = {
    "delivery.scheduled": {
        "delivery_id": required(TEXT),
        "shipment_id": required(TEXT),
        "tracking_number": required(TEXT),
        "scheduled_date": required(TIME),
        "time_window_start": optional(TIME),
        "time_window_end": optional(TIME),
        "destination_address": required(structure("address")),
        "delivery_instructions": optional(TEXT),
        "requires_signature": optional(FLAG),
        "is_residential": optional(FLAG),
        "origin_facility_id": required(TEXT),
        "carrier_id": required(TEXT),
        "priority": optional(INTEGER | {"minimum": 1, "maximum": 10}),
        "is_expedited": optional(FLAG),
    },
    "delivery.started": {
        "delivery_id": required(TEXT),
        "shipment_id": required(TEXT),
        "driver_id": required(TEXT),
        "vehicle_id": optional(TEXT),
        "started_at": required(TIME),
        "departed_facility_id": required(TEXT),
        "departure_time": required(TIME),
        "route_id": optional(TEXT),
        "stop_number": required(INTEGER | {"minimum": 1}),
        "total_stops": required(INTEGER | {"minimum": 1}),
        "estimated_arrival_time": required(TIME),
        "distance_remaining_km": required(NUMBER | {"minimum": 0}),
    },
    "delivery.attempted": {
        "delivery_id": required(TEXT),
        "shipment_id": required(TEXT),
        "driver_id": required(TEXT),
        "attempt_number": required(INTEGER | {"minimum": 1}),
        "was_successful": required(FLAG),
        "attempt_time": required(TIME),
        "location": required(structure("location")),
        "failure_reason": optional(one_of("failure_reason")),
        "failure_notes": optional(TEXT),
        "delivery_location": optional(one_of("delivery_location")),
        "signed_by": optional(TEXT),
        "photo_url": optional(TEXT),
    },
    "delivery.completed": {
        "delivery_id": required(TEXT),
        "shipment_id": required(TEXT),
        "driver_id": required(TEXT),
        "completed_at": required(TIME),
        "delivery_location": required(one_of("delivery_location")),
        "location": required(structure("location")),
        "signature_obtained": optional(FLAG),
        "signed_by": optional(TEXT),
        "photo_url": optional(TEXT),
        "delivery_notes": optional(TEXT),
        "attempt_count": optional(INTEGER | {"minimum": 1}),
        "scheduled_time": required(TIME),
        "was_on_time": required(FLAG),
        "time_variance_minutes": optional(INTEGER),
    },
    "delivery.failed": {
        "delivery_id": required(TEXT),
        "shipment_id": required(TEXT),
        "driver_id": required(TEXT),
        "failed_at": required(TIME),
        "total_attempts": required(INTEGER | {"minimum": 1}),
        "failure_reason": required(one_of("failure_reason")),
        "failure_notes": optional(TEXT),
        "next_action": required(TEXT),
        "reschedule_date": optional(TIME),
        "return_to_facility_id": optional(TEXT),
    },
    "delivery.rescheduled": {
        "delivery_id": required(TEXT),
        "shipment_id": required(TEXT),
        "previous_scheduled_date": required(TIME),
        "new_scheduled_date": required(TIME),
        "new_time_window_start": optional(TIME),
        "new_time_window_end": optional(TIME),
        "reschedule_reason": required(TEXT),
        "requested_by": required(TEXT),
        "attempt_count": optional(INTEGER | {"minimum": 0}),
    },
}

# The fields of driver events
DRIVER = {
    "driver.created": {
        "driver_id": required(TEXT),
        "carrier_id": required(TEXT),
        "home_facility_id": required(TEXT),
        "first_name": required(TEXT),
        "last_name": required(TEXT),
        "email": optional(TEXT),
        "phone": optional(TEXT),
        "license_number": required(TEXT),
        "license_state": required(TEXT),
        "license_type": required(TEXT),
        "license_expiry": required(TIME),
        "vehicle_type": required(one_of("vehicle_type")),
        "vehicle_id": optional(TEXT),
        "status": optional(one_of("driver_status")),
        "hire_date": required(TIME),
    },
    "driver.updated": {
        "driver_id": required(TEXT),
        "updated_fields": required(LIST),
        "home_facility_id": optional(TEXT),
        "vehicle_type": optional(one_of("vehicle_type")),
        "vehicle_id": optional(TEXT),
        "license_expiry": optional(TIME),
    },
    "driver.assigned": {
        "driver_id": required(TEXT),
        "assignment_id": required(TEXT),
        "assignment_type": required(TEXT),
        "facility_id": required(TEXT),
        "route_id": optional(TEXT),
        "delivery_ids": optional(LIST),
        "shipment_count": optional(INTEGER | {"minimum": 0}),
        "assigned_at": required(TIME),
        "expected_start_time": required(TIME),
        "expected_end_time": required(TIME),
        "expected_distance_km": optional(NUMBER | {"minimum": 0}),
    },
    "driver.location_updated": {
        "driver_id": required(TEXT),
        "vehicle_id": optional(TEXT),
        "location": required(structure("location")),
        "current_status": required(one_of("driver_status")),
        "current_delivery_id": optional(TEXT),
        "route_id": optional(TEXT),
        "distance_traveled_km": optional(NUMBER | {"minimum": 0}),
        "deliveries_completed": optional(INTEGER | {"minimum": 0}),
        "deliveries_remaining": optional(INTEGER | {"minimum": 0}),
    },
    "driver.status_changed": {
        "driver_id": required(TEXT),
        "previous_status": required(one_of("driver_status")),
        "new_status": required(one_of("driver_status")),
        "status_reason": optional(TEXT),
        "location": optional(structure("location")),
        "facility_id": optional(TEXT),
        "shift_start_time": optional(TIME),
        "break_start_time": optional(TIME),
    },
}

# The fields of facility events
FACILITY = {
    "facility.created": {
        "facility_id": required(TEXT),
        "facility_name": required(TEXT),
        "facility_type": required(one_of("facility_type")),
        "facility_code": required(TEXT),
        "address": required(structure("address")),
        "timezone": optional(TEXT),
        "capacity_units": optional(INTEGER | {"minimum": 0}),
        "capacity_volume_cubic_meters": optional(NUMBER | {"minimum": 0}),
        "max_daily_throughput": optional(INTEGER | {"minimum": 0}),
        "region_id": optional(TEXT),
        "manager_id": optional(TEXT),
        "carrier_ids": optional(LIST),
        "supports_hazmat": optional(FLAG),
        "supports_refrigeration": optional(FLAG),
        "supports_oversized": optional(FLAG),
        "has_sorting_equipment": optional(FLAG),
        "status": optional(one_of("facility_status")),
        "opened_date": optional(TIME),
    },
    "facility.updated": {
        "facility_id": required(TEXT),
        "updated_fields": required(LIST),
        "facility_name": optional(TEXT),
        "address": optional(structure("address")),
        "status": optional(one_of("facility_status")),
        "capacity_units": optional(INTEGER | {"minimum": 0}),
        "max_daily_throughput": optional(INTEGER | {"minimum": 0}),
    },
    "facility.capacity_changed": {
        "facility_id": required(TEXT),
        "current_units": required(INTEGER | {"minimum": 0}),
        "max_capacity_units": required(INTEGER | {"minimum": 0}),
        "utilization_percentage": required(NUMBER | {"minimum": 0, "maximum": 100}),
        "previous_utilization_percentage": required(NUMBER | {"minimum": 0, "maximum": 100}),
        "change_reason": optional(TEXT),
        "is_at_capacity": optional(FLAG),
        "is_critical": optional(FLAG),
    },
    "facility.status_changed": {
        "facility_id": required(TEXT),
        "previous_status": required(one_of("facility_status")),
        "new_status": required(one_of("facility_status")),
        "status_reason": required(TEXT),
        "expected_resolution_time": optional(TIME),
        "affected_shipment_count": optional(INTEGER | {"minimum": 0}),
        "requires_rerouting": optional(FLAG),
        "alternative_facility_id": optional(TEXT),
    },
}

EVENTS = SHIPMENT | DELIVERY | DRIVER | FACILITY


def _object(fields: dict[str, tuple[dict, bool]]) -> dict:
    return {"type": "object", "required": [n for n, (_, need) in fields.items() if need], "properties": {n: node for n, (node, _) in fields.items()}}


def schemas(*event_types: str) -> dict[str, dict]:
    """JSON Schemas of the given event types, or of all; optional plain fields may be null."""
    definitions = {n: _object(s) for n, s in STRUCTURES.items()}
    return {t: _object(EVENTS[t]) | {"definitions": definitions} for t in event_types or EVENTS}

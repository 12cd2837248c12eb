"""Dimension attributes joined to events: one row per key, broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions import jsontext
from harborline.operators.lookup import lookup

# Attributes that each dimension lends to events
LENT = {
    "facility": {"name": "facility_name", "type": "facility_type", "region_id": "region_id", "timezone": "timezone"},
    "carrier": {"name": "carrier_name", "type": "carrier_type", "scac_code": "scac_code"},
    "driver": {"carrier_id": "carrier_id", "home_facility_id": "home_facility_id", "vehicle_type": "vehicle_type"},
}


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """The current row of each key, else the latest; rows without a key are left out. Missing SCD columns are allowed."""
    order = [F.col(c).desc_nulls_last() for c in ("is_current", "effective_from") if c in dim.columns] + [F.to_json(F.struct(*[c for c in dim.columns])).asc()]
    return dim.where(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def enrich(events: DataFrame, row_id: str = "event_id", **dims: DataFrame | None) -> DataFrame:
    """events with `_facility`, `_carrier` and `_driver` structs of the dimensions given; null where there is no match.

    A dimension that isn't given adds nothing. Attributes that a dimension lacks are null. The payload is parsed once.
    """
    ids = jsontext.Scalars("payload", [f"{name}{tail}" for name in LENT for tail in ("_id", "Id")], "_ids")
    events = events.withColumn("_ids", ids.column())
    keys = {f"_key_{name}": F.coalesce(ids.get(f"{name}_id"), ids.get(f"{name}Id")) for name in LENT if dims.get(name) is not None}
    events = events.withColumns(keys).drop("_ids") if keys else events.drop("_ids")
    for name in LENT:
        dim = dims.get(name)
        if dim is None:
            continue
        key = f"{name}_id"
        cols = [(F.col(c) if c in dim.columns else F.lit(None).cast("string")).alias(a) for a, c in LENT[name].items()]
        lent = one_per_key(dim, key).select(F.col(key).alias(f"_key_{name}"), F.struct(*cols).alias(f"_{name}"))
        events = lookup(events, lent, f"_key_{name}", row_id).drop(f"_key_{name}")
    return events

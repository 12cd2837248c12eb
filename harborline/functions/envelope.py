"""Derived attributes of an envelope, paths, small arithmetic and parameter types."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedupe_key(event_type: Column, event_id: Column) -> Column:
    return F.concat(event_type, F.lit(":"), event_id)


def domain(event_type: Column) -> Column:
    """Text before the first dot."""
    return F.split_part(event_type, F.lit("."), F.lit(1))


def action(event_type: Column) -> Column:
    """Text between the first and second dot; unknown where there is no dot."""
    return F.when(event_type.contains("."), F.split_part(event_type, F.lit("."), F.lit(2))).otherwise("unknown")


def bronze_path(event_type: Column, event_time: Column) -> Column:
    """domain/event_date=YYYY-MM-DD/hour=HH."""
    return F.concat(domain(event_type), F.lit("/event_date="), F.date_format(event_time, "yyyy-MM-dd"), F.lit("/hour="), F.date_format(event_time, "HH"))


def volume_cm3(length: Column, width: Column, height: Column) -> Column:
    return length * width * height


def dimensional_weight_kg(length: Column, width: Column, height: Column) -> Column:
    """Volume over 5000."""
    return volume_cm3(length, width, height) / F.lit(5000.0)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Whole minutes, cut towards zero."""
    return F.timestamp_diff("MINUTE", earlier, later)


def literal_type(value) -> T.DataType:
    """Spark type of a query parameter; booleans come before integers and datetimes before dates, all else is text."""
    kinds = [(bool, T.BooleanType()), (int, T.LongType()), (float, T.DoubleType()), (dt.datetime, T.TimestampType()), (dt.date, T.DateType())]
    return next((t for k, t in kinds if isinstance(value, k)), T.StringType())

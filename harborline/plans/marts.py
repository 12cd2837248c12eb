"""Gold facts, dimensions with history, checks of sources and results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.functions import envelope, jsontext, masking
from harborline.operators.lookup import BROADCAST_BYTES
from harborline.operators.slices import sliced
from harborline.session import materialize, plan_bytes
from harborline.sources import sinks
from harborline.types import GOLD

_P = jsontext.Scalars("payload", []).get


def _read(events: DataFrame, paths: list[str]) -> DataFrame:
    """events with the named fields of the payload, in one parse, for _P."""
    return events.withColumn("_scalars", jsontext.Scalars("payload", paths).column())


_TIME = lambda path: F.regexp_replace(_P(path), "Z", "+00:00").try_cast("timestamp")


def _when(kind: str, value: Column) -> Column:
    return F.when(F.col("event_type") == f"delivery.{kind}", value)


def fact_deliveries(events: DataFrame, day: str | None = None, by_delivery_date: bool = False, key: Column | None = None) -> DataFrame:
    """One row per completed delivery and day of its events, in one shuffle.

    day: only that day's events; else every day is built on its own. by_delivery_date: days are those of the completion
    instead. key: the delivery, by default the promoted column. The latest completed and scheduled events count, ties go to
    the larger event_id; a delivery without a key has no schedule and no attempt. No completed event, no row.
    """
    key = F.col("delivery_id") if key is None else key
    events = events.where(F.col("event_type").isin("delivery.scheduled", "delivery.attempted", "delivery.completed"))
    if day and not by_delivery_date:
        events = events.where(F.to_date("event_time") == F.lit(day).cast("date"))
    events = _read(events, ["delivery_id", "shipment_id", "driver_id", "completed_at", "attempt_count", "was_on_time", "carrier_id", "scheduled_date"])
    day_of = F.lit(None).cast("date") if by_delivery_date else F.to_date("event_time")
    done = F.struct(
        _P("delivery_id").alias("delivery_id"), _P("shipment_id").alias("shipment_id"), "facility_id", _P("driver_id").alias("driver_id"),
        _TIME("completed_at").alias("delivery_time"), _P("attempt_count").try_cast("long").alias("attempt_count"), (_P("was_on_time") == "true").alias("on_time_flag"),
    )
    planned = F.struct(_P("carrier_id").alias("carrier_id"), _TIME("scheduled_date").alias("scheduled_time"))
    order = F.struct("event_time", "event_id")
    grouped = events.groupBy(day_of.alias("_day"), key.alias("_key")).agg(
        F.max_by(_when("completed", done), _when("completed", order)).alias("c"),
        F.max_by(_when("scheduled", planned), _when("scheduled", order)).alias("s"),
        F.min(_when("attempted", F.col("event_time"))).alias("attempt"),
    )
    own = lambda c: F.when(F.col("_key").isNotNull(), c)
    attempt = own(F.col("attempt"))
    rows = grouped.where("c IS NOT NULL").select(
        "c.delivery_id", "c.shipment_id", F.to_date("c.delivery_time").alias("delivery_date"), "c.facility_id", "c.driver_id", own(F.col("s.carrier_id")).alias("carrier_id"),
        F.lit("completed").alias("status"), own(F.col("s.scheduled_time")).alias("scheduled_time"), "c.delivery_time", attempt.alias("first_attempt_time"), "c.attempt_count", "c.on_time_flag",
        envelope.minutes_between(F.col("c.delivery_time"), F.coalesce(attempt, F.col("c.delivery_time"))).alias("delivery_duration_minutes"),
    )
    return rows.where(F.col("delivery_date") == F.lit(day).cast("date")) if day and by_delivery_date else rows


def fact_shipment_events(events: DataFrame, day: str | None = None) -> DataFrame:
    """A projection of shipment events; repeated events stay repeated."""
    events = events.where(F.to_date("event_time") == F.lit(day).cast("date")) if day else events
    return _read(events, ["driver_id", "status", "location.latitude", "location.longitude"]).select(
        "event_id", "shipment_id", F.to_date("event_time").alias("event_date"), "event_type", "event_time", "facility_id", "carrier_id", _P("driver_id").alias("driver_id"),
        _P("status").alias("status"), _P("location.latitude").try_cast("double").alias("latitude"), _P("location.longitude").try_cast("double").alias("longitude"),
    )


def facility_tuples(events: DataFrame) -> DataFrame:
    """Distinct attribute tuples of facility events with the time each was last seen; an unstated status is active."""
    address = [f"address.{a}" for a in ("street", "city", "state", "country", "postal_code", "latitude", "longitude")]
    return _read(events, ["facility_name", "facility_type", *address, "timezone", "capacity_units", "status"]).groupBy(
        "facility_id", _P("facility_name").alias("facility_name"), _P("facility_type").alias("facility_type"), *[_P(f"address.{a}").alias(b) for a, b in (("street", "address"), ("city", "city"), ("state", "state"), ("country", "country"), ("postal_code", "postal_code"))],
        _P("address.latitude").try_cast("double").alias("latitude"), _P("address.longitude").try_cast("double").alias("longitude"), _P("timezone").alias("timezone"),
        _P("capacity_units").try_cast("long").alias("capacity_units"), (F.coalesce(_P("status"), F.lit("active")) == "active").alias("is_active"),
    ).agg(F.max("event_time").alias("last_updated"))


def carrier_tuples(events: DataFrame) -> DataFrame:
    """Distinct carriers of shipment events."""
    return _read(events.where("carrier_id IS NOT NULL"), ["carrier_name", "carrier_type", "scac_code"]).groupBy("carrier_id", *[_P(c).alias(c) for c in ("carrier_name", "carrier_type", "scac_code")]).agg(F.max("event_time").alias("last_updated")).withColumn("is_active", F.lit(True))


def driver_tuples(events: DataFrame, key: bytes) -> DataFrame:
    """Distinct drivers of driver events: the name only as a keyed hash; active unless unavailable or off duty for good."""
    name = F.concat_ws(" ", _P("first_name"), _P("last_name"))
    events = _read(events, ["driver_id", "first_name", "last_name", "carrier_id", "home_facility_id", "license_type", "status"])
    return events.where(_P("driver_id").isNotNull()).groupBy(
        _P("driver_id").alias("driver_id"), F.when(name != "", masking.token(F.lower(name), key)).alias("driver_name_hash"), *[_P(c).alias(c) for c in ("carrier_id", "home_facility_id", "license_type")],
        (F.coalesce(_P("status"), F.lit("available")) != "unavailable").alias("is_active"),
    ).agg(F.max("event_time").alias("last_updated"))


def build_day(spark: SparkSession, out: str, events: DataFrame, day: str, attempts: Callable = lambda task: task()) -> dict[str, bool]:
    """The gold tables of a day, in order: source checks, dimensions, facts, quality checks; returns the checks' results.

    A failed source check raises before anything is written, a failed quality check after. A day built again replaces
    itself: facts by partition, each day's state of a dimension under its day, made from the state of the day before.
    attempts: runs each step, for retries.
    """
    of_day = lambda df: df.where(F.to_date("event_time") == F.lit(day).cast("date"))
    sources = attempts(lambda: source_checks(events, day).first().asDict())
    if not all(sources.values()):
        raise RuntimeError(f"sources of {day} fail their checks: {sources}")
    seen = {
        "dim_facility": (facility_tuples(of_day(events.where(envelope.domain(F.col("event_type")) == "facility"))), "facility_id", ["facility_name", "facility_type", "is_active"], True),
        "dim_carrier": (carrier_tuples(of_day(events.where(envelope.domain(F.col("event_type")) == "shipment"))), "carrier_id", [], False),
    }
    for name, (tuples, key, compared, close) in seen.items():
        earlier = _latest_before(spark, f"{out}/{name}", day)
        dim = spark.read.schema(GOLD[name]).parquet(earlier) if earlier else spark.createDataFrame([], GOLD[name])
        attempts(lambda: merge_history(dim, tuples, key, compared, full=True, close=close).write.mode("overwrite").parquet(f"{out}/{name}/as_of={day}"))
    events_of_shipments = fact_shipment_events(events.where(envelope.domain(F.col("event_type")) == "shipment"), day)
    attempts(lambda: sinks.write_gold(fact_deliveries(events, day), f"{out}/fact_deliveries", "delivery_date"))
    attempts(lambda: sinks.write_gold(events_of_shipments, f"{out}/fact_shipment_events", "event_date"))
    facts = spark.read.parquet(f"{out}/fact_deliveries").where(F.col("delivery_date") == F.lit(day).cast("date"))
    quality = attempts(lambda: quality_checks(facts, day).first().asDict())
    if not all(quality.values()):
        raise RuntimeError(f"facts of {day} fail their checks: {quality}")
    return sources | quality


def _latest_before(spark: SparkSession, path: str, day: str) -> str | None:
    """The folder as_of=DAY of the latest day before `day`."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    earlier = [n for n in names if n.startswith("as_of=") and n[6:] < day]
    return f"{path}/{max(earlier)}" if earlier else None


def merge_history(dim: DataFrame, seen: DataFrame, key: str, compared: list[str], full: bool = False, close: bool = True) -> DataFrame:
    """dim after a merge of tuples `seen` (with last_updated) into its current rows.

    Plain mode: a changed current row is closed and its successor waits for a later run; comparison with null finds no
    change; an unmatched tuple is inserted, each of several. Full mode: the latest tuple per key, null-safe comparison,
    close and insert at once. close=False only inserts. Rows of dim without change are kept; an empty dim is allowed.
    """
    order = F.struct("last_updated", F.to_json(F.struct(*[c for c in seen.columns if c != "last_updated"])))
    if full:
        seen = seen.groupBy(key).agg(F.max_by(F.struct(*[c for c in seen.columns if c != key]), order).alias("x")).select(key, "x.*")
    differs = lambda a, b: ~a.eqNullSafe(b) if full else F.coalesce(a != b, F.lit(False))
    news = seen.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in compared], F.col("last_updated").alias("_at"))
    current = dim.where("is_current").join(news, F.col(key) == F.col("_key"), "left")
    changed = F.lit(False)
    for c in compared:
        changed = changed | differs(F.col(c), F.col(f"_new_{c}"))
    changed = changed & F.col("_key").isNotNull() & F.lit(close)
    kept = current.groupBy(*dim.columns).agg(F.max(F.when(changed, F.col("_at"))).alias("_closed"))
    kept = kept.withColumns({"effective_to": F.coalesce("_closed", "effective_to"), "is_current": F.col("_closed").isNull()}).select(*dim.columns)
    shape = [F.col(c) if c in seen.columns else F.col("last_updated").alias(c) if c == "effective_from" else F.lit(True).alias(c) if c == "is_current" else F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in dim.columns]
    unmatched = seen.join(dim.where("is_current").select(key), key, "left_anti").select(*shape)
    out = dim.where("NOT is_current").unionByName(kept).unionByName(unmatched)
    if full and close:
        closed = current.where(changed).select(F.col("_key").alias(key)).distinct()
        out = out.unionByName(seen.join(closed, key, "left_semi").select(*shape))
    return out


def source_checks(events: DataFrame, day: str | None = None) -> DataFrame:
    """(shipments, deliveries, facilities): whether the sources of a day hold enough."""
    events = events.where(F.to_date("event_time") == F.lit(day).cast("date")) if day else events
    n = lambda d: F.count_if(envelope.domain(F.col("event_type")) == d)
    return events.agg((n("shipment") > 0).alias("shipments"), (n("delivery") > 0).alias("deliveries"), (n("facility") >= 0).alias("facilities"))


def quality_checks(facts: DataFrame, day: str | None = None, key: str = "delivery_id", date: str = "delivery_date") -> DataFrame:
    """(has_data, no_duplicates, correct_partition) of facts, for a day or over all."""
    wrong = F.count_if(F.col(date).isNull() if day is None else ~F.col(date).eqNullSafe(F.lit(day).cast("date")))
    return facts.agg((F.count("*") > 0).alias("has_data"), (F.count_distinct(key) == F.count(key)).alias("no_duplicates"), (wrong == 0).alias("correct_partition"))


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of nulls per column, one row; null for an empty table."""
    return df.agg(*[F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), F.count("*")).alias(c) for c in columns])


def duplicate_rate(df: DataFrame, key: str) -> DataFrame:
    """Share of rows with a key that are repeats."""
    return df.agg((1 - F.try_divide(F.count_distinct(key).cast("double"), F.count(key))).alias("duplicate_rate"))


def asof(events: DataFrame, dim: DataFrame, key: str, time: str = "event_time", limit: int = BROADCAST_BYTES) -> DataFrame:
    """events with the version of their dimension valid at their time, or nulls; the versions of a key don't overlap.

    dim is written first. Up to `limit` bytes it is broadcast, and events aren't shuffled. Beyond that events and versions
    are sorted together over slices (see operators.slices) and the last version is carried forward, so that a key with
    very many events and versions meets in no task.
    """
    dim = materialize(dim.where(F.col(key).isNotNull() & F.col("effective_from").isNotNull()), "versions")
    others = [c for c in dim.columns if c != key]
    if plan_bytes(dim) <= limit:
        d = dim.select(F.col(key).alias("_key"), *others)
        valid = (F.col(key) == F.col("_key")) & (F.col(time) >= F.col("effective_from")) & (F.col("effective_to").isNull() | (F.col(time) < F.col("effective_to")))
        return events.join(F.broadcast(d), valid, "left").drop("_key")
    row, version = F.struct(*[F.col(f"`{c}`") for c in events.columns]), F.struct(*others)
    placed = F.col(f"`{key}`").isNotNull() & F.col(f"`{time}`").isNotNull()
    rows = events.where(placed).select(F.col(f"`{key}`").alias("_key"), F.col(f"`{time}`").alias("_at"), row.alias("_row"))
    both = rows.unionByName(dim.select(F.col(key).alias("_key"), F.col("effective_from").alias("_at"), version.alias("_version")), allowMissingColumns=True)
    both = sliced(both, ["_key"], ["_at"], "asof")
    ends = both.groupBy("_key", "_slice").agg(F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_at"))).alias("_end"))
    carried = ends.select("_key", "_slice", F.last("_end", ignorenulls=True).over(Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)).alias("_in"))
    running = Window.partitionBy("_key", "_slice").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_seen", F.last("_version", ignorenulls=True).over(running)).where("_row IS NOT NULL")
    found = found.join(carried, ["_key", "_slice"]).withColumn("_v", F.coalesce("_seen", "_in"))
    valid = F.col("_v.effective_to").isNull() | (F.col("_at") < F.col("_v.effective_to"))
    found = found.select("_row.*", F.when(valid, F.col("_v")).alias("_v")).select(*[F.col(f"`{c}`") for c in events.columns], "_v.*")
    return found.unionByName(events.where(~placed), allowMissingColumns=True)

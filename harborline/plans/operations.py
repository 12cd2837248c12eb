"""Late partitions and their repair, service levels, and the queries that serve readers. Every `as_of` is given, never the clock."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.plans import marts

# Limits by environment
LIMITS = {"prod": {"lag_minutes": 15, "delay_hours": 2, "least_events": 1000}, "dev": {"lag_minutes": 60, "delay_hours": 6, "least_events": 10}}
NOTHING = 999


def _at(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def late_dates(events: DataFrame, as_of: str, recent_hours: int = 4, late_hours: int = 4, lookback_days: int = 7, more_than: int = 10) -> DataFrame:
    """(event_date, late_count) of days that got late events lately, in order."""
    at = _at(as_of)
    recent = events.where((F.col("ingest_time") >= at - F.expr(f"INTERVAL {recent_hours} HOURS")) & (F.col("event_time") < at - F.expr(f"INTERVAL {late_hours} HOURS")) & (F.to_date("event_time") >= F.date_sub(F.to_date(at), lookback_days)))
    return recent.groupBy(F.to_date("event_time").alias("event_date")).agg(F.count("*").alias("late_count")).where(F.col("late_count") > more_than).orderBy("event_date")


def repair(spark: SparkSession, path: str, events: DataFrame, dates: DataFrame) -> None:
    """Rebuild the fact partitions of the given dates, all in one job, by dynamic partition overwrite.

    Facts go by completion date, so that what is replaced is what is rebuilt; dates without facts keep their old rows.
    """
    facts = marts.fact_deliveries(events, by_delivery_date=True)
    wanted = facts.join(dates.select(F.col("event_date").alias("delivery_date")).distinct(), "delivery_date", "left_semi")
    wanted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery_date").parquet(path)


def streaming_lag(events: DataFrame, as_of: str) -> DataFrame:
    """(lag_minutes): minutes since the last arrival within the hour, 999 for none."""
    at = _at(as_of)
    return events.where(F.col("ingest_time") >= at - F.expr("INTERVAL 1 HOUR")).agg(F.coalesce(F.timestamp_diff("MINUTE", F.max("ingest_time"), at), F.lit(NOTHING)).cast("long").alias("lag_minutes"))


def freshness(facts: DataFrame, as_of: str) -> DataFrame:
    """(latest_partition, days_behind)."""
    latest = F.max("delivery_date")
    return facts.agg(latest.alias("latest_partition"), F.coalesce(F.date_diff(F.to_date(_at(as_of)), latest), F.lit(NOTHING)).cast("long").alias("days_behind"))


def volume(events: DataFrame, as_of: str) -> DataFrame:
    """(event_count) of the last 24 hours."""
    return events.where(F.col("event_time") >= _at(as_of) - F.expr("INTERVAL 24 HOURS")).agg(F.count("*").alias("event_count"))


def sla_report(events: DataFrame, facts: DataFrame, as_of: str, environment: str = "prod", dead: DataFrame | None = None) -> DataFrame:
    """One row: each measure and whether it is within its limit."""
    limit = LIMITS.get(environment, LIMITS["dev"])
    row = streaming_lag(events, as_of).crossJoin(freshness(facts, as_of)).crossJoin(volume(events, as_of))  # one row each
    row = row.crossJoin(dead.agg(F.count("*").alias("dead_letters"))) if dead is not None else row.withColumn("dead_letters", F.lit(0).cast("long"))
    late = (F.col("days_behind") > 1) & (F.col("days_behind") * 24 > limit["delay_hours"])
    return row.select("*", (F.col("lag_minutes") <= limit["lag_minutes"]).alias("lag_ok"), (~late).alias("freshness_ok"), (F.col("event_count") >= limit["least_events"]).alias("volume_ok"), (F.col("dead_letters") == 0).alias("dead_letters_ok"))


def alerts(report: DataFrame, environment: str = "prod") -> DataFrame:
    """(severity, title) of each limit that is broken."""
    prod = environment == "prod"
    rules = [("lag_ok", "critical" if prod else "warning", "streaming lag"), ("freshness_ok", "high", "gold partition delay"), ("volume_ok", "warning", "low data volume"), ("dead_letters_ok", "warning", "dead letters")]
    each = F.explode(F.array_compact(F.array(*[F.when(~F.col(c), F.struct(F.lit(s).alias("severity"), F.lit(t).alias("title"))) for c, s, t in rules]))).alias("a")
    return report.select(each).select("a.*")


def send(alert_rows: DataFrame, chat: Callable | None = None, pager: Callable | None = None, environment: str = "prod") -> int:
    """Hand alerts to callbacks: chat gets all, the pager severe ones in production. A callback's failure is swallowed; returns the calls that worked."""
    done = 0
    for r in alert_rows.collect():  # at most one row per rule
        severe = r.severity in ("critical", "high") and environment == "prod"
        for call in [c for c in (chat, pager if severe else None) if c]:
            try:
                call(r.severity, r.title)
                done += 1
            except Exception:  # noqa: BLE001, S110
                pass
    return done


def timeline(facts: DataFrame, shipment_id: str | None = None) -> DataFrame:
    """Events of a shipment (or of all) in order; a location counts only where neither coordinate is zero or null."""
    facts = facts if shipment_id is None else facts.where(F.col("shipment_id") == shipment_id)
    there = F.when((F.col("latitude") != 0) & (F.col("longitude") != 0), F.struct("latitude", "longitude")).alias("location")
    return facts.select("shipment_id", "event_id", "event_type", "event_time", "facility_id", "status", there).orderBy("shipment_id", "event_time", "event_id")


def _metrics() -> list[Column]:
    on_time = F.count_if("on_time_flag")
    return [
        F.count("*").alias("total_deliveries"), on_time.alias("on_time_deliveries"), F.coalesce(F.try_divide(on_time.cast("double"), F.count("*")), F.lit(0.0)).alias("on_time_rate"),
        F.avg("delivery_duration_minutes").alias("avg_delivery_duration_minutes"), F.coalesce(F.sum("attempt_count"), F.lit(0)).cast("long").alias("total_attempts"),
    ]


def facility_metrics(facts: DataFrame, facility_id: str | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """Metrics per facility and day, for one facility or all, over a range of days."""
    if facility_id is not None:
        facts = facts.where(F.col("facility_id") == facility_id)
    if first:
        facts = facts.where(F.col("delivery_date") >= F.lit(first).cast("date"))
    if last:
        facts = facts.where(F.col("delivery_date") <= F.lit(last).cast("date"))
    return facts.groupBy("facility_id", "delivery_date").agg(*_metrics())


def platform_daily(facts: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Metrics per day over all facilities; with events, also the failed deliveries of the day (of delivery.failed, by delivery)."""
    rows = facts.groupBy("delivery_date").agg(F.count_distinct("shipment_id").alias("shipments"), *_metrics())
    if events is None:
        return rows
    failed = events.where("event_type = 'delivery.failed'").groupBy(F.to_date("event_time").alias("delivery_date")).agg(F.count_distinct("delivery_id").alias("failed_deliveries"))
    return rows.join(failed, "delivery_date", "full").fillna(0, ["shipments", "total_deliveries", "on_time_deliveries", "total_attempts", "failed_deliveries"]).fillna(0.0, ["on_time_rate"])


def carrier_performance(facts: DataFrame, limit: int = 10) -> DataFrame:
    """The `limit` carriers with most deliveries (1 to 50)."""
    if not 1 <= limit <= 50:
        raise ValueError("limit must be 1 to 50")
    rows = facts.groupBy("carrier_id").agg(*_metrics(), F.avg("attempt_count").alias("avg_attempts"))
    return rows.orderBy(F.desc("total_deliveries"), "carrier_id").limit(limit)


def regional_summary(facts: DataFrame) -> DataFrame:
    """Metrics per region with its number of facilities."""
    return facts.groupBy("region_id").agg(F.count_distinct("facility_id").alias("facilities"), *_metrics())


def facility_day(facts: DataFrame, facility_id: str, as_of: str, day: str | None = None) -> dict | None:
    """Metrics of a facility on a day, by default the one before `as_of`; None if it has no deliveries then."""
    at = F.date_sub(F.to_date(_at(as_of)), 1) if day is None else F.lit(day).cast("date")
    rows = facility_metrics(facts.where(F.col("delivery_date") == at), facility_id).collect()  # one row at most
    return rows[0].asDict() if rows else None


def shipment_events(facts: DataFrame, shipment_id: str, limit: int = 100) -> DataFrame:
    """The first events of a shipment in order, 1 to 1000."""
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be 1 to 1000")
    return timeline(facts, shipment_id).limit(limit)


def facilities(dim: DataFrame, facility_id: str | None = None, kind: str | None = None, active: bool | None = None, region: str | None = None) -> DataFrame:
    """Current rows of a facility dimension, filtered by whatever is given; a dimension without is_current is current as a whole."""
    rows = dim.where("is_current") if "is_current" in dim.columns else dim
    for column, value in (("facility_id", facility_id), ("facility_type", kind), ("is_active", active), ("region_id", region)):
        rows = rows if value is None else rows.where(F.col(column) == value)
    return rows


def shipments(events: DataFrame, status: str | None = None, carrier: str | None = None, shipment_id: str | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """One row per shipment: latest status and carrier, time of creation and of delivery; first and last bound the day of creation."""
    events = events if shipment_id is None else events.where(F.col("shipment_id") == shipment_id)
    kind = lambda k: F.when(F.col("event_type") == f"shipment.{k}", F.col("event_time"))
    order = F.struct("event_time", "event_id")
    rows = events.groupBy("shipment_id").agg(F.max_by("status", order).alias("status"), F.max_by("carrier_id", order).alias("carrier_id"), F.min(kind("created")).alias("created_at"), F.max(kind("delivered")).alias("delivered_at"))
    rows = rows if status is None else rows.where(F.col("status") == status)
    rows = rows if first is None else rows.where(F.to_date("created_at") >= F.lit(first).cast("date"))
    rows = rows if last is None else rows.where(F.to_date("created_at") <= F.lit(last).cast("date"))
    return rows if carrier is None else rows.where(F.col("carrier_id") == carrier)


def page(rows: DataFrame, order: list[str], number: int = 1, size: int = 20) -> tuple[DataFrame, int]:
    """A page of rows in a total order, and the count of all. number from 1 on, size 1 to 100."""
    if number < 1 or not 1 <= size <= 100:
        raise ValueError("pages count from 1 and hold 1 to 100 rows")
    return rows.orderBy(*order).offset((number - 1) * size).limit(size), rows.count()


def table_name(project: str, dataset: str, table: str) -> str:
    """The quoted name of a table in the catalog."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in (project, dataset, table) if p)


def retried(task: Callable, times: int = 2, wait_s: float = 300, sleep: Callable[[float], None] = time.sleep):
    """The task's result; a failure is tried again `times` times, the last one is raised."""
    for n in range(times + 1):
        try:
            return task()
        except Exception:
            if n == times:
                raise
            sleep(wait_s)


def execute(spark: SparkSession, sql: str, **parameters) -> list[dict]:
    """Rows of a parameterised statement (named markers) as dictionaries."""
    return [r.asDict(recursive=True) for r in spark.sql(sql, args=parameters).collect()]

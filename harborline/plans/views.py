"""Logistics-shaped views over the general test tables, by one deterministic rule for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.session import table

#: The moment that stands for now, as the tables lie in the past.
AS_OF = "2024-01-31 00:00:00"

_DIALECT = {
    "spark": {"later": "event_time + make_interval(0, 0, 0, 0, CAST(event_id % 7 AS INT))", "iso": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")", "minutes": "ingest_time + INTERVAL 5 MINUTES", "day": "dayofmonth(ts)", "str": "STRING"},
    "duckdb": {"later": "event_time + to_hours(CAST(event_id % 7 AS INT))", "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S')", "minutes": "ingest_time + INTERVAL 5 MINUTE", "day": "dayofmonth(ts)", "str": "VARCHAR"},
}


def silver_sql(dialect: str) -> str:
    """Clean events of all domains over the table events."""
    d = _DIALECT[dialect]
    sql = f"""
    SELECT concat('evt-', event_id) AS event_id, concat(domain, '.', action) AS event_type, 'v1' AS event_version, event_time, {d['later']} AS ingest_time,
           CAST(NULL AS {d['str']}) AS trace_id, CASE WHEN event_id % 2 = 0 THEN 'app' ELSE 'web' END AS source_system,
           concat('{{"delivery_id":"DLV-', user_id, '","shipment_id":"SHP-', user_id, '","driver_id":"DRV-', user_id % 20, '","carrier_id":"CAR-', user_id % 5,
                  '","facility_id":"FAC-', user_id % 12, '","facility_name":"Hub ', user_id % 12, ' v', {d['day']} % 4, '","facility_type":"', CASE WHEN {d['day']} % 5 = 0 THEN 'store' ELSE 'hub' END,
                  '","region_id":"REG-', user_id % 3, '","carrier_name":"Carrier ', user_id % 5, '","status":"', original, '","attempt_count":', event_id % 4,
                  ',"was_on_time":', CASE WHEN event_id % 3 = 0 THEN 'false' ELSE 'true' END, ',"completed_at":"', iso, 'Z","scheduled_date":"', iso, 'Z"',
                  ',"location":{{"latitude":', event_id % 90, '.25,"longitude":-', event_id % 180, '.5}}}}') AS payload,
           concat(domain, '.', action, ':evt-', event_id) AS dedupe_key, concat('SHP-', user_id) AS shipment_id, concat('TRK', user_id) AS tracking_number,
           concat('CAR-', user_id % 5) AS carrier_id, concat('FAC-', user_id % 12) AS facility_id, concat('DRV-', user_id % 20) AS driver_id,
           concat('DLV-', user_id) AS delivery_id, domain
    FROM (SELECT event_id, user_id, ts AS event_time, ts, {d['iso']} AS iso, event_type AS original,
                 CASE event_type WHEN 'click' THEN 'shipment' WHEN 'view' THEN 'facility' WHEN 'signup' THEN 'driver' WHEN 'purchase' THEN 'delivery' ELSE 'other' END AS domain,
                 CASE WHEN event_type = 'purchase' THEN CASE event_id % 3 WHEN 0 THEN 'scheduled' WHEN 1 THEN 'attempted' ELSE 'completed' END
                      WHEN event_type = 'click' THEN CASE event_id % 3 WHEN 0 THEN 'created' WHEN 1 THEN 'in_transit' ELSE 'delivered' END
                      ELSE CASE event_id % 3 WHEN 0 THEN 'created' WHEN 1 THEN 'updated' ELSE 'status_changed' END END AS action
          FROM events)"""
    return sql.replace("{", "{{").replace("}", "}}").replace("FROM events)", "FROM {events})") if dialect == "spark" else sql  # braces are fields there


def silver_dup_sql(dialect: str) -> str:
    """Clean events with one in ten delivered again five minutes later."""
    s = "{silver}" if dialect == "spark" else f"({silver_sql(dialect)})"
    cols = "event_id, event_type, event_version, event_time, {i} AS ingest_time, trace_id, source_system, payload, dedupe_key, shipment_id, domain"
    return f"SELECT {cols.replace('{i}', 'ingest_time')} FROM {s} UNION ALL SELECT {cols.replace('{i}', _DIALECT[dialect]['minutes'])} FROM {s} WHERE event_id LIKE '%0'"


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(silver_sql("spark"), events=table(spark, sf, "events"))


def silver_dup(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(silver_dup_sql("spark"), silver=silver(spark, sf))


DELIVERIES_SQL = """
    SELECT concat('DLV-', l_orderkey, '-', l_linenumber) AS delivery_id, concat('SHP-', l_orderkey) AS shipment_id, CAST(l_shipdate AS DATE) AS delivery_date,
           concat('FAC-', l_suppkey) AS facility_id, concat('REG-', l_suppkey % 5) AS region_id, o_orderpriority AS carrier_id, 'completed' AS status,
           l_linenumber AS attempt_count, l_returnflag <> 'R' AS on_time_flag, CAST(l_quantity AS BIGINT) * 7 AS delivery_duration_minutes
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery facts over lineitem and orders."""
    return spark.sql(DELIVERIES_SQL, lineitem=table(spark, sf, "lineitem"), orders=table(spark, sf, "orders"))


DELIVERIES = DELIVERIES_SQL.replace("{lineitem}", "lineitem").replace("{orders}", "orders")
SILVER, SILVER_DUP = silver_sql("duckdb"), silver_dup_sql("duckdb")


def dimensions(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Facilities from nations, carriers from regions, drivers from suppliers."""
    n, r, s = (table(spark, sf, t) for t in ("nation", "region", "supplier"))
    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    return {
        "facility": n.select(text("FAC-", "n_nationkey").alias("facility_id"), F.col("n_name").alias("facility_name"), F.lit("hub").alias("facility_type"), text("REG-", "n_regionkey").alias("region_id"), F.lit("UTC").alias("timezone")),
        "carrier": r.select(text("CAR-", "r_regionkey").alias("carrier_id"), F.col("r_name").alias("carrier_name"), F.lit("road").alias("carrier_type"), F.lit(None).cast("string").alias("scac_code")),
        "driver": s.select(text("DRV-", "s_suppkey").alias("driver_id"), text("CAR-", "s_nationkey").alias("carrier_id"), text("FAC-", "s_nationkey").alias("home_facility_id"), F.lit("van").alias("vehicle_type")),
    }

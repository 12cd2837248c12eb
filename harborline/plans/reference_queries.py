"""Queries of the platform's own operators over whole tables, each with its SQL.

Times come out as microseconds since 1970 UTC and fractions rounded, so that both engines give equal values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions import envelope, masking
from harborline.operators import dedupe, enrich, normalize, route, validate, windows
from harborline.plans import marts, operations, views
from harborline.plans.views import AS_OF, DELIVERIES, SILVER, SILVER_DUP
from harborline.session import comparable, table

_KEY = b"harborline test key"
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = lambda spark, sf: comparable(f(spark, sf))
        if sql:
            ORACLE[name] = sql
        return f

    return keep


# ---- normalisation -------------------------------------------------------------------------------------------------

_BODIES = {
    # message variants by event_id % 6: aliases in either case, attributes, epoch seconds, no payload, broken JSON
    "spark": """
    SELECT event_id AS n, CAST(CASE event_id % 6
        WHEN 0 THEN concat('{"event_id":"E', event_id, '","event_type":"shipment.created","event_time":"', iso, 'Z","source":"s1","payload":{"a":', event_id, '}}')
        WHEN 1 THEN concat('{"eventId":"E', event_id, '","timestamp":', unix, ',"shipment_id":"S1","delivery_id":"D1","trace_id":null}')
        WHEN 2 THEN concat('{"id":null,"type":"driver.updated","created_at":"nonsense","data":{"b":"x"},"schema_version":"v2"}')
        WHEN 3 THEN concat('{"deliveryId":"D', event_id, '","eventTime":"', iso, '+02:00"}')
        WHEN 4 THEN 'not json'
        ELSE concat('{"event_time":"","occurred_at":"', iso, '","payload":[1],"note":"n"}') END AS BINARY) AS data,
        map('event_id', concat('A', event_id), 'source_system', 'attr') AS attributes
    FROM (SELECT event_id, date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") AS iso, unix_seconds(ts) AS unix FROM events)""",
    "duckdb": """SELECT event_id AS n, event_id % 6 AS v, ts, date_trunc('second', ts) AS s FROM events""",
}
_INGEST = "TIMESTAMP '2024-02-01 00:00:00'"


def messages(spark, sf) -> DataFrame:
    sql = _BODIES["spark"].replace("{", "{{").replace("}", "}}").replace("FROM events)", "FROM {events})")
    return spark.sql(sql, events=table(spark, sf, "events"))


def _envelopes(spark, sf) -> DataFrame:
    return normalize.normalize(messages(spark, sf), ingest_time=F.lit("2024-02-01 00:00:00").cast("timestamp"), new_id=F.lit("new"))


_NORMALIZED = f"""
    SELECT CASE v WHEN 0 THEN concat('E', n) WHEN 1 THEN concat('A', n) ELSE concat('A', n) END AS event_id,
           CASE v WHEN 0 THEN 'shipment.created' WHEN 1 THEN 'shipment.unknown' WHEN 2 THEN 'driver.updated' WHEN 3 THEN 'delivery.unknown' ELSE 'unknown' END AS event_type,
           CASE v WHEN 2 THEN 'v2' ELSE 'v1' END AS event_version,
           epoch_us(CASE v WHEN 0 THEN s WHEN 1 THEN s WHEN 3 THEN s - INTERVAL 2 HOUR WHEN 5 THEN s ELSE {_INGEST} END) AS event_time,
           epoch_us({_INGEST}) AS ingest_time, CASE v WHEN 0 THEN 'attr' ELSE 'attr' END AS source_system, CASE v WHEN 1 THEN 'None' END AS trace_id
    FROM ({_BODIES['duckdb']})"""


@query("q_normalize_envelope", _NORMALIZED)
def _(spark, sf):
    return _envelopes(spark, sf).drop("payload")


@query("q_event_type_infer", f"SELECT event_type, count(*) AS n FROM ({_NORMALIZED}) GROUP BY ALL")
def _(spark, sf):
    return _envelopes(spark, sf).groupBy("event_type").agg(F.count("*").alias("n"))


@query("q_timestamp_parse", f"SELECT event_id, event_time FROM ({_NORMALIZED})")
def _(spark, sf):
    return _envelopes(spark, sf).select("event_id", "event_time")


@query(
    "q_payload_extract",
    f"""SELECT CASE v WHEN 0 THEN concat('E', n) ELSE concat('A', n) END AS event_id, CASE v WHEN 0 THEN CAST(n AS VARCHAR) END AS a, CASE v WHEN 2 THEN 'x' END AS b,
               CASE v WHEN 1 THEN 'D1' END AS delivery_id, CASE v WHEN 3 THEN concat('D', n) END AS camel, CASE v WHEN 4 THEN 'not json' END AS raw, CASE v WHEN 5 THEN 'n' END AS note,
               CASE v WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN 1 ELSE 2 END::BIGINT AS keys
        FROM ({_BODIES['duckdb']})""",
)
def _(spark, sf):
    get = lambda k: F.get_json_object("payload", f"$.{k}")
    names = {"a": "a", "b": "b", "delivery_id": "delivery_id", "camel": "deliveryId", "raw": "raw_data", "note": "note"}
    return _envelopes(spark, sf).select("event_id", *[get(k).alias(n) for n, k in names.items()], F.size(F.json_object_keys("payload")).alias("keys"))


# ---- validation ----------------------------------------------------------------------------------------------------

#: A schema of the reference's keywords, for clean events of the delivery and shipment domains.
SCHEMAS = {
    "delivery": {
        "type": "object", "required": ["delivery_id", "location", "signed_by"],
        "properties": {
            "attempt_count": {"type": "integer", "minimum": 1}, "was_on_time": {"type": "boolean"}, "status": {"enum": ["purchase", "view"]},
            "driver_id": {"type": "string", "pattern": "^DRV-[0-9]$"}, "location": {"$ref": "#/definitions/place"},
        },
        "definitions": {"place": {"type": "object", "properties": {"latitude": {"type": "number", "maximum": 60}, "longitude": {"type": "number", "exclusiveMinimum": -90}}}},
    },
    "shipment.created_v1": {"type": "object", "required": ["origin"], "properties": {"shipment_id": {"type": "string", "maxLength": 6}, "carrier_name": {"type": "number"}}},
}


def _validated(spark, sf) -> DataFrame:
    silver = views.silver(spark, sf).withColumn("n", F.substring_index("event_id", "-", -1).cast("long"))
    # some events without id, type or the domain's field
    n = F.col("n")
    broken = silver.withColumns({
        "event_type": F.when(n % 50 == 0, "").when(n % 50 == 1, "nodot").otherwise(F.col("event_type")),
        "payload": F.when(n % 50 == 2, F.lit("{}")).otherwise(F.col("payload")), "event_id": F.when(n % 50 == 3, "").otherwise(F.col("event_id")),
    })
    return validate.validated(broken, SCHEMAS)


_BROKEN = f"""
    SELECT * REPLACE (CASE WHEN n % 50 = 0 THEN '' WHEN n % 50 = 1 THEN 'nodot' ELSE event_type END AS event_type, CASE WHEN n % 50 = 2 THEN '{{}}' ELSE payload END AS payload,
                      CASE WHEN n % 50 = 3 THEN '' ELSE event_id END AS event_id)
    FROM (SELECT *, CAST(split_part(event_id, '-', 2) AS BIGINT) AS n FROM ({SILVER}))"""
_P = lambda path: f"json_extract_string(payload, '$.{path}')"
_ERRORS = f"""
    WITH b AS ({_BROKEN}), d AS (SELECT *, split_part(event_type, '.', 1) AS dom FROM b)
    SELECT n, 'event_id' AS field, 'REQUIRED_FIELD' AS error_code FROM d WHERE event_id = ''
    UNION ALL SELECT n, 'event_type', 'REQUIRED_FIELD' FROM d WHERE event_type = ''
    UNION ALL SELECT n, 'event_type', 'INVALID_FORMAT' FROM d WHERE event_type <> '' AND event_type NOT LIKE '%.%'
    UNION ALL SELECT n, unnest(['root', 'root']), 'SCHEMA_VIOLATION' FROM d WHERE dom = 'delivery' AND payload = '{{}}'
    UNION ALL SELECT n, 'root', 'SCHEMA_VIOLATION' FROM d WHERE dom = 'delivery'
    UNION ALL SELECT n, 'attempt_count', 'SCHEMA_VIOLATION' FROM d WHERE dom = 'delivery' AND CAST({_P('attempt_count')} AS BIGINT) < 1
    UNION ALL SELECT n, 'status', 'SCHEMA_VIOLATION' FROM d WHERE dom = 'delivery' AND {_P('status')} NOT IN ('purchase', 'view')
    UNION ALL SELECT n, 'driver_id', 'SCHEMA_VIOLATION' FROM d WHERE dom = 'delivery' AND NOT regexp_matches({_P('driver_id')}, '^DRV-[0-9]$')
    UNION ALL SELECT n, 'location.latitude', 'SCHEMA_VIOLATION' FROM d WHERE dom = 'delivery' AND CAST({_P('location.latitude')} AS DOUBLE) > 60
    UNION ALL SELECT n, 'location.longitude', 'SCHEMA_VIOLATION' FROM d WHERE dom = 'delivery' AND CAST({_P('location.longitude')} AS DOUBLE) <= -90
    UNION ALL SELECT n, 'root', 'SCHEMA_VIOLATION' FROM d WHERE event_type = 'shipment.created'
    UNION ALL SELECT n, 'shipment_id', 'SCHEMA_VIOLATION' FROM d WHERE event_type = 'shipment.created' AND length({_P('shipment_id')}) > 6
    UNION ALL SELECT n, 'carrier_name', 'SCHEMA_VIOLATION' FROM d WHERE event_type = 'shipment.created' AND {_P('carrier_name')} IS NOT NULL
    UNION ALL SELECT n, dom || '_id', 'MISSING_DOMAIN_FIELD' FROM d WHERE dom IN ('shipment', 'facility', 'driver', 'delivery') AND payload = '{{}}'"""


@query("q_validation_error_codes", _ERRORS)
def _(spark, sf):
    return _validated(spark, sf).select("n", F.explode("errors").alias("e")).select("n", "e.field", "e.error_code")


@query("q_validate_split", f"SELECT n, n NOT IN (SELECT n FROM ({_ERRORS})) AS is_valid FROM ({_BROKEN})")
def _(spark, sf):
    return _validated(spark, sf).select("n", (F.size("errors") == 0).alias("is_valid"))


@query("q_dead_letters", f"SELECT event_id, event_type, count(*)::VARCHAR AS validation_error_count FROM ({_ERRORS}) e JOIN ({_BROKEN}) b USING (n) GROUP BY event_id, event_type, n")
def _(spark, sf):
    _, invalid = validate.split(_validated(spark, sf))
    a = F.col("attributes")
    return route.dead_letters(invalid).select(a["event_id"].alias("event_id"), a["event_type"].alias("event_type"), a["validation_error_count"].alias("validation_error_count"))


@query(
    "q_model_constraints",
    """SELECT day, field, count(*) AS n FROM (
        SELECT CAST(event_timestamp AS DATE) AS day, unnest(list_filter([
            CASE WHEN location.heading * 1.2 >= 360 THEN 'location.heading' END, CASE WHEN location.speed_mps - 1 < 0 THEN 'location.speed_mps' END,
            CASE WHEN current_status = 'on_break' THEN 'current_status' END, CASE WHEN route_id IS NULL AND deliveries_remaining = 0 THEN 'root' END,
            CASE WHEN distance_traveled_km + 0.25 <> floor(distance_traveled_km + 0.25) THEN 'deliveries_completed' END], lambda f: f IS NOT NULL)) AS field FROM driver_locations) GROUP BY ALL""",
)
def _(spark, sf):
    from harborline import event_models

    pings, place = table(spark, sf, "driver_locations"), F.col("location")
    bent = F.struct(place["latitude"].alias("latitude"), place["longitude"].alias("longitude"), (place["heading"] * 1.2).alias("heading"), (place["speed_mps"] - 1).alias("speed_mps"))
    missing = F.col("route_id").isNull() & (F.col("deliveries_remaining") == 0)
    body = F.to_json(F.struct(
        F.when(~missing, F.col("driver_id")).alias("driver_id"), bent.alias("location"), F.when(F.col("current_status") == "on_break", "asleep").otherwise(F.col("current_status")).alias("current_status"),
        (F.col("distance_traveled_km") + 0.25).alias("deliveries_completed"),
    ))
    events = pings.select(F.to_date("event_timestamp").alias("day"), F.col("ping_id").cast("string").alias("event_id"), F.lit("driver.location_updated").alias("event_type"), F.lit("v1").alias("event_version"), body.alias("payload"))
    errors = validate.validated(events, event_models.schemas("driver.location_updated")).select("day", F.explode("errors").alias("e")).where("e.error_code = 'SCHEMA_VIOLATION'")
    return errors.groupBy("day", F.col("e.field").alias("field")).agg(F.count("*").alias("n"))


# ---- duplicates, routes, dimensions ----------------------------------------------------------------------------------

_ROW = "row_number() OVER (PARTITION BY event_type, event_id ORDER BY ingest_time)"


@query("q_dedupe_first_by_ingest", f"SELECT event_id, epoch_us(ingest_time) AS ingest_time FROM (SELECT *, {_ROW} AS rn FROM ({SILVER_DUP})) WHERE rn = 1")
def _(spark, sf):
    d = views.silver_dup(spark, sf).withColumn("row", F.xxhash64("event_id", "ingest_time"))
    return dedupe.keep_first(d, row_id="row").select("event_id", "ingest_time")


@query("q_dedupe_by_key", f"SELECT dedupe_key, count(*) AS copies, epoch_us(min(ingest_time)) AS first_ingest FROM ({SILVER_DUP}) GROUP BY dedupe_key")
def _(spark, sf):
    key = envelope.dedupe_key(F.col("event_type"), F.col("event_id"))
    return views.silver_dup(spark, sf).groupBy(key.alias("dedupe_key")).agg(F.count("*").alias("copies"), F.min("ingest_time").alias("first_ingest"))


@query("q_route_domain_counts", f"SELECT CASE WHEN domain IN ('shipment', 'facility', 'driver', 'delivery') THEN domain ELSE 'other' END AS route, count(*) AS n FROM ({SILVER}) GROUP BY ALL")
def _(spark, sf):
    return route.with_route(views.silver(spark, sf)).groupBy("route").agg(F.count("*").alias("n"))


@query("q_route_priority_counts", f"""SELECT CASE WHEN event_type IN ('shipment.created', 'shipment.delivered', 'delivery.completed', 'delivery.failed') THEN 'high'
    WHEN event_type = 'driver.location_updated' THEN 'low' ELSE 'normal' END AS priority, count(*) AS n FROM ({SILVER}) GROUP BY ALL""")
def _(spark, sf):
    return route.with_priority(views.silver(spark, sf)).groupBy("priority").agg(F.count("*").alias("n"))


@query("q_filter_types", f"SELECT event_id, event_type FROM ({SILVER}) WHERE event_type IN ('delivery.completed', 'driver.updated')")
def _(spark, sf):
    return route.only_types(views.silver(spark, sf), ["delivery.completed", "driver.updated"]).select("event_id", "event_type")


@query("q_envelope_parts", f"""SELECT event_id, domain, split_part(event_type, '.', 2) AS action, concat(domain, '/event_date=', strftime(event_time, '%Y-%m-%d'), '/hour=', strftime(event_time, '%H')) AS path FROM ({SILVER})""")
def _(spark, sf):
    t = F.col("event_type")
    return views.silver(spark, sf).select("event_id", envelope.domain(t).alias("domain"), envelope.action(t).alias("action"), envelope.bronze_path(t, F.col("event_time")).alias("path"))


@query("q_enrich_broadcast", f"""
    SELECT s.event_id, n_name AS facility_name, CASE WHEN n_name IS NOT NULL THEN concat('REG-', n_regionkey) END AS region_id, r_name AS carrier_name, CASE WHEN s_suppkey IS NOT NULL THEN concat('FAC-', s_nationkey) END AS home_facility_id
    FROM ({SILVER}) s LEFT JOIN nation ON facility_id = concat('FAC-', n_nationkey) LEFT JOIN region ON carrier_id = concat('CAR-', r_regionkey) LEFT JOIN supplier ON driver_id = concat('DRV-', s_suppkey)""")
def _(spark, sf):
    out = enrich.enrich(views.silver(spark, sf), **views.dimensions(spark, sf))
    return out.select("event_id", F.col("_facility.name").alias("facility_name"), F.col("_facility.region_id").alias("region_id"), F.col("_carrier.name").alias("carrier_name"), F.col("_driver.home_facility_id").alias("home_facility_id"))


# ---- masks and tokens --------------------------------------------------------------------------------------------------

_STARS = "array_to_string(list_transform(list_filter(string_split_regex({c}, '\\s+'), lambda w: w <> ''), lambda w: CASE WHEN length(w) > 1 THEN w[1] || repeat('*', length(w) - 1) ELSE {short} END), '{by}')"


@query("q_mask_name", "SELECT c_custkey, " + _STARS.format(c="replace(c_name, '#', ' ')", short="w", by=" ") + " AS masked FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", masking.mask_value("customer_name", F.regexp_replace("c_name", "#", " ")).alias("masked"))


@query("q_mask_email", "SELECT c_custkey, substr(c_name, 1, 1) || '***@' || " + _STARS.format(c="replace('mail.' || lower(c_mktsegment) || '.x', '.', ' ')", short="'*'", by=".") + " AS masked FROM customer")
def _(spark, sf):
    c = F.concat("c_name", F.lit("@mail."), F.lower("c_mktsegment"), F.lit(".x"))
    return table(spark, sf, "customer").select("c_custkey", masking.mask_value("contact_email", c).alias("masked"))


@query("q_mask_phone", "SELECT c_custkey, CASE WHEN length(c_custkey::VARCHAR) >= 4 THEN '***-***-' || right(c_custkey::VARCHAR, 4) ELSE '***-***-****' END AS masked FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", masking.mask_value("phone", F.concat(F.lit("tel "), F.col("c_custkey"))).alias("masked"))


@query("q_mask_address", "SELECT p_partkey, " + _STARS.format(c="array_to_string(string_split(p_name || ' ' || p_type, ' ')[1:3], ' ')", short="'*'", by=" ") + " || ' ***' AS masked FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", masking.mask_value("street", F.concat_ws(" ", "p_name", "p_type")).alias("masked"))


@query("q_mask_generic", "SELECT p_partkey, CASE WHEN length(p_brand) <= 3 THEN repeat('*', length(p_brand)) ELSE p_brand[1] || repeat('*', length(p_brand) - 2) || right(p_brand, 1) END AS masked FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", masking.mask_value("ssn", F.col("p_brand")).alias("masked"))


_PAD = _KEY.ljust(64, b"\0")


@query("q_tokenize", f"""SELECT c_custkey, 'tok_' || left(sha256(unhex('{bytes(b ^ 0x5C for b in _KEY.ljust(64, bytes(1))).hex()}') || unhex(sha256(unhex('{bytes(b ^ 0x36 for b in _KEY.ljust(64, bytes(1))).hex()}') || encode('salt:' || c_name)))), 16) AS token FROM customer""")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", masking.token(F.col("c_name"), _KEY, "salt").alias("token"))


# ---- windows -------------------------------------------------------------------------------------------------------------


@query("q_tumbling_counts", f"SELECT domain, epoch_us(time_bucket(INTERVAL 300 SECOND, event_time)) AS window_start, epoch_us(time_bucket(INTERVAL 300 SECOND, event_time)) + 300000000 AS window_end, count(*) AS n FROM ({SILVER}) GROUP BY ALL")
def _(spark, sf):
    return windows.tumbling(views.silver(spark, sf), ["domain"])


@query("q_sliding_counts", f"""SELECT domain, w AS window_start, w + 300000000 AS window_end, count(*) AS n
    FROM (SELECT domain, unnest(list_transform(range(5), lambda k: epoch_us(event_time) - epoch_us(event_time) % 60000000 - k * 60000000)) AS w FROM ({SILVER})) GROUP BY ALL""")
def _(spark, sf):
    return windows.sliding(views.silver(spark, sf), ["domain"])


@query("q_session_counts", f"""
    WITH e AS (SELECT shipment_id, epoch_us(event_time) AS t FROM ({SILVER})), g AS (SELECT *, CASE WHEN t - lag(t) OVER w < 300000000 THEN 0 ELSE 1 END AS s FROM e WINDOW w AS (PARTITION BY shipment_id ORDER BY t)),
    i AS (SELECT *, sum(s) OVER (PARTITION BY shipment_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT shipment_id, min(t) AS window_start, max(t) + 300000000 AS window_end, count(*) AS n FROM i GROUP BY shipment_id, k""")
def _(spark, sf):
    return windows.session(views.silver(spark, sf), ["shipment_id"])


# ---- gold ----------------------------------------------------------------------------------------------------------------

_JS = lambda a, p: f"json_extract_string({a}.payload, '$.{p}')"
_DONE_TIME = "CAST(replace({}, 'Z', '') AS TIMESTAMP)"
_FACT = f"""
    WITH e AS (SELECT *, CAST(event_time AS DATE) AS d FROM ({SILVER}) WHERE domain = 'delivery'),
         r AS (SELECT *, row_number() OVER (PARTITION BY d, delivery_id, event_type ORDER BY event_time DESC, event_id DESC) AS rn FROM e),
         a AS (SELECT d, delivery_id, min(event_time) AS at FROM e WHERE event_type = 'delivery.attempted' GROUP BY ALL)
    SELECT {_JS('c', 'delivery_id')} AS delivery_id, {_JS('c', 'shipment_id')} AS shipment_id, CAST({_DONE_TIME.format(_JS('c', 'completed_at'))} AS DATE) AS delivery_date, c.facility_id,
           {_JS('c', 'driver_id')} AS driver_id, {_JS('s', 'carrier_id')} AS carrier_id, 'completed' AS status, epoch_us({_DONE_TIME.format(_JS('s', 'scheduled_date'))}) AS scheduled_time,
           epoch_us({_DONE_TIME.format(_JS('c', 'completed_at'))}) AS delivery_time, epoch_us(a.at) AS first_attempt_time, CAST({_JS('c', 'attempt_count')} AS BIGINT) AS attempt_count,
           {_JS('c', 'was_on_time')} = 'true' AS on_time_flag, date_sub('minute', coalesce(a.at, {_DONE_TIME.format(_JS('c', 'completed_at'))}), {_DONE_TIME.format(_JS('c', 'completed_at'))}) AS delivery_duration_minutes
    FROM (SELECT * FROM r WHERE event_type = 'delivery.completed' AND rn = 1) c LEFT JOIN (SELECT * FROM r WHERE event_type = 'delivery.scheduled' AND rn = 1) s USING (d, delivery_id) LEFT JOIN a USING (d, delivery_id)"""
_SHIPMENT_FACT = f"""
    SELECT event_id, shipment_id, CAST(event_time AS DATE) AS event_date, event_type, epoch_us(event_time) AS event_time, facility_id, carrier_id, {_P('driver_id')} AS driver_id, {_P('status')} AS status,
           CAST({_P('location.latitude')} AS DOUBLE) AS latitude, CAST({_P('location.longitude')} AS DOUBLE) AS longitude FROM ({SILVER}) WHERE domain = 'shipment'"""


def _facts(spark, sf):
    return marts.fact_deliveries(views.silver(spark, sf).where("domain = 'delivery'"))


def _shipment_facts(spark, sf):
    return marts.fact_shipment_events(views.silver(spark, sf).where("domain = 'shipment'"))


@query("q_row_number_latest", f"""SELECT delivery_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY delivery_id, event_type ORDER BY event_time DESC, event_id DESC) AS rn FROM ({SILVER})) WHERE rn = 1""")
def _(spark, sf):
    return views.silver(spark, sf).groupBy("delivery_id", "event_type").agg(F.max_by("event_id", F.struct("event_time", "event_id")).alias("event_id"))


@query("q_fact_deliveries", _FACT)
def _(spark, sf):
    return _facts(spark, sf)


@query("q_fact_shipment_events", _SHIPMENT_FACT)
def _(spark, sf):
    return _shipment_facts(spark, sf)


@query("q_source_checks", f"SELECT count(*) FILTER (domain = 'shipment') > 0 AS shipments, count(*) FILTER (domain = 'delivery') > 0 AS deliveries, count(*) FILTER (domain = 'facility') >= 0 AS facilities FROM ({SILVER})")
def _(spark, sf):
    return marts.source_checks(views.silver(spark, sf))


@query("q_quality_checks", f"SELECT count(*) > 0 AS has_data, count(DISTINCT delivery_id) = count(delivery_id) AS no_duplicates, count(*) FILTER (delivery_date IS NULL) = 0 AS correct_partition FROM ({_FACT})")
def _(spark, sf):
    return marts.quality_checks(_facts(spark, sf))


@query("q_null_rate", f"SELECT round(avg((carrier_id IS NULL)::INT), 6) AS carrier_id, round(avg((first_attempt_time IS NULL)::INT), 6) AS first_attempt_time FROM ({_FACT})")
def _(spark, sf):
    return marts.null_rates(_facts(spark, sf), ["carrier_id", "first_attempt_time"])


@query("q_duplicate_rate", f"SELECT round(1 - count(DISTINCT dedupe_key) / count(dedupe_key), 6) AS duplicate_rate FROM ({SILVER_DUP})")
def _(spark, sf):
    return marts.duplicate_rate(views.silver_dup(spark, sf), "dedupe_key")


_TUPLES = f"""SELECT CAST(event_time AS DATE) AS day, facility_id, {_P('facility_name')} AS facility_name, {_P('facility_type')} AS facility_type, coalesce({_P('status')}, 'active') = 'active' AS is_active, max(event_time) AS last_updated
    FROM ({SILVER}) WHERE domain = 'facility' GROUP BY ALL"""


@query("q_dim_latest_tuple", f"SELECT facility_id, arg_max(facility_name, last_updated) AS facility_name, epoch_us(max(last_updated)) AS last_updated FROM ({_TUPLES}) GROUP BY facility_id")
def _(spark, sf):
    t = marts.facility_tuples(views.silver(spark, sf).where("domain = 'facility'"))
    return t.groupBy("facility_id").agg(F.max_by("facility_name", "last_updated").alias("facility_name"), F.max("last_updated").alias("last_updated"))


_BEFORE, _AFTER = "event_time < TIMESTAMP '2024-01-15'", "event_time >= TIMESTAMP '2024-01-15'"


def _half(spark, sf, when: str):
    return views.silver(spark, sf).where("domain = 'facility'").where(when)


def _dim(spark, sf):
    """The dimension after the first half of the events: the latest tuple of each facility."""
    from harborline.types import GOLD

    empty = spark.createDataFrame([], GOLD["dim_facility"])
    return marts.merge_history(empty, marts.facility_tuples(_half(spark, sf, _BEFORE)), "facility_id", ["facility_name", "facility_type", "is_active"], full=True)


def _latest(when: str) -> str:
    return f"""SELECT facility_id, unnest(arg_max({{'n': facility_name, 't': facility_type, 'u': u}}, u)) FROM (SELECT facility_id, {_P('facility_name')} AS facility_name, {_P('facility_type')} AS facility_type, max(event_time) AS u
        FROM ({SILVER}) WHERE domain = 'facility' AND {when} GROUP BY ALL) GROUP BY facility_id"""


_MERGED = f"""
    WITH o AS ({_latest(_BEFORE)}), s AS ({_latest(_AFTER)})
    SELECT o.facility_id, o.n AS facility_name, epoch_us(o.u) AS effective_from, epoch_us(CASE WHEN s.n <> o.n OR s.t <> o.t THEN s.u END) AS effective_to, NOT coalesce(s.n <> o.n OR s.t <> o.t, false) AS is_current FROM o LEFT JOIN s USING (facility_id)
    UNION ALL SELECT s.facility_id, s.n, epoch_us(s.u), NULL, true FROM s LEFT JOIN o USING (facility_id) WHERE o.n IS NULL"""


@query("q_scd2_merge_full", _MERGED + " UNION ALL SELECT s.facility_id, s.n, epoch_us(s.u), NULL, true FROM s JOIN o USING (facility_id) WHERE s.n <> o.n OR s.t <> o.t")
def _(spark, sf):
    merged = marts.merge_history(_dim(spark, sf), marts.facility_tuples(_half(spark, sf, _AFTER)), "facility_id", ["facility_name", "facility_type", "is_active"], full=True)
    return merged.select("facility_id", "facility_name", "effective_from", "effective_to", "is_current")


@query("q_scd2_merge_reference", _MERGED)
def _(spark, sf):
    seen = marts.facility_tuples(_half(spark, sf, _AFTER))
    latest = seen.groupBy("facility_id").agg(F.max_by(F.struct(*[c for c in seen.columns if c != "facility_id"]), "last_updated").alias("x")).select("facility_id", "x.*")
    merged = marts.merge_history(_dim(spark, sf), latest, "facility_id", ["facility_name", "facility_type", "is_active"])
    return merged.select("facility_id", "facility_name", "effective_from", "effective_to", "is_current")


@query("q_carrier_insert_only", f"""SELECT carrier_id, {_P('carrier_name')} AS carrier_name, true AS is_active, epoch_us(max(event_time)) AS effective_from, true AS is_current
    FROM ({SILVER}) WHERE domain = 'shipment' GROUP BY ALL""")
def _(spark, sf):
    from harborline.types import GOLD

    seen = marts.carrier_tuples(views.silver(spark, sf).where("domain = 'shipment'"))
    out = marts.merge_history(spark.createDataFrame([], GOLD["dim_carrier"]), seen, "carrier_id", [], close=False)
    return out.select("carrier_id", "carrier_name", "is_active", "effective_from", "is_current")


_HISTORY = f"""
    WITH x AS (SELECT facility_id, {_P('facility_name')} AS facility_name, event_time AS t, event_id FROM ({SILVER}) WHERE domain = 'facility'),
         l AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY facility_id, t ORDER BY event_id DESC) = 1),
         c AS (SELECT *, facility_name IS DISTINCT FROM lag(facility_name) OVER (PARTITION BY facility_id ORDER BY t) AS starts FROM l)
    SELECT facility_id, facility_name, t AS effective_from, lead(t) OVER (PARTITION BY facility_id ORDER BY t) AS effective_to FROM c WHERE starts"""


def _facility_versions(spark, sf):
    from harborline.operators import history

    e = views.silver(spark, sf).where("domain = 'facility'")
    rows = e.select(F.col("facility_id").alias("entity"), F.col("event_time").alias("at"), F.dense_rank().over(Window.partitionBy("facility_id", "event_time").orderBy("event_id")).cast("decimal(38,0)").alias("_ord"), F.struct(F.get_json_object("payload", "$.facility_name").alias("v")).alias("facility_name"))
    return history.versions(rows, ["facility_name"], created_by_any=True).select(F.col("entity").alias("facility_id"), "facility_name", F.col("valid_from").alias("effective_from"), F.col("valid_to").alias("effective_to"))


@query("q_scd2_history", f"SELECT * REPLACE (epoch_us(effective_from) AS effective_from, epoch_us(effective_to) AS effective_to) FROM ({_HISTORY})")
def _(spark, sf):
    return _facility_versions(spark, sf)


@query("q_asof_dim_join", f"""SELECT event_id, facility_name FROM ({SILVER}) s LEFT JOIN ({_HISTORY}) h ON s.facility_id = h.facility_id AND event_time >= effective_from AND (effective_to IS NULL OR event_time < effective_to)""")
def _(spark, sf):
    return marts.asof(views.silver(spark, sf), _facility_versions(spark, sf), "facility_id").select("event_id", "facility_name")


# ---- operations and serving ------------------------------------------------------------------------------------------------

_NOW = f"TIMESTAMP '{AS_OF}'"


@query("q_late_dates", f"""SELECT CAST(event_time AS DATE) AS event_date, count(*) AS late_count FROM ({SILVER}) WHERE ingest_time >= {_NOW} - INTERVAL 4 HOUR AND event_time < {_NOW} - INTERVAL 4 HOUR
    AND CAST(event_time AS DATE) >= CAST({_NOW} AS DATE) - 7 GROUP BY ALL HAVING count(*) > 10""")
def _(spark, sf):
    return operations.late_dates(views.silver(spark, sf), AS_OF)


_LAG = f"SELECT coalesce(date_sub('minute', max(ingest_time), {_NOW}), 999) AS lag_minutes FROM ({SILVER}) WHERE ingest_time >= {_NOW} - INTERVAL 1 HOUR"
_FRESH = f"SELECT max(delivery_date) AS latest_partition, coalesce(date_diff('day', max(delivery_date), CAST({_NOW} AS DATE)), 999) AS days_behind FROM ({_FACT})"
_VOLUME = f"SELECT count(*) AS event_count FROM ({SILVER}) WHERE event_time >= {_NOW} - INTERVAL 24 HOUR"


@query("q_sla_lag", _LAG)
def _(spark, sf):
    return operations.streaming_lag(views.silver(spark, sf), AS_OF)


@query("q_sla_freshness", _FRESH)
def _(spark, sf):
    return operations.freshness(_facts(spark, sf), AS_OF)


@query("q_sla_volume", _VOLUME)
def _(spark, sf):
    return operations.volume(views.silver(spark, sf), AS_OF)


_REPORT = f"SELECT *, 0::BIGINT AS dead_letters, lag_minutes <= 15 AS lag_ok, NOT (days_behind > 1 AND days_behind * 24 > 2) AS freshness_ok, event_count >= 1000 AS volume_ok, true AS dead_letters_ok FROM ({_LAG}), ({_FRESH}), ({_VOLUME})"


@query("q_sla_report", _REPORT)
def _(spark, sf):
    return operations.sla_report(views.silver(spark, sf), _facts(spark, sf), AS_OF)


@query("q_alerts", f"SELECT 'critical' AS severity, 'streaming lag' AS title FROM ({_REPORT}) WHERE NOT lag_ok UNION ALL SELECT 'high', 'gold partition delay' FROM ({_REPORT}) WHERE NOT freshness_ok UNION ALL SELECT 'warning', 'low data volume' FROM ({_REPORT}) WHERE NOT volume_ok")
def _(spark, sf):
    return operations.alerts(operations.sla_report(views.silver(spark, sf), _facts(spark, sf), AS_OF))


@query("q_shipment_timeline", f"""SELECT shipment_id, event_id, event_type, event_time, facility_id, status, CASE WHEN latitude <> 0 AND longitude <> 0 THEN latitude END AS latitude, CASE WHEN latitude <> 0 AND longitude <> 0 THEN longitude END AS longitude FROM ({_SHIPMENT_FACT})""")
def _(spark, sf):
    t = operations.timeline(_shipment_facts(spark, sf))
    return t.select("shipment_id", "event_id", "event_type", "event_time", "facility_id", "status", "location.latitude", "location.longitude")


_METRICS = """count(*) AS total_deliveries, count(*) FILTER (on_time_flag) AS on_time_deliveries, round(coalesce(count(*) FILTER (on_time_flag) / nullif(count(*), 0), 0), 6) AS on_time_rate,
    round(avg(delivery_duration_minutes), 6) AS avg_delivery_duration_minutes, CAST(coalesce(sum(attempt_count), 0) AS BIGINT) AS total_attempts"""


@query("q_facility_metrics", f"SELECT facility_id, delivery_date, {_METRICS} FROM ({DELIVERIES}) GROUP BY ALL")
def _(spark, sf):
    return operations.facility_metrics(views.deliveries(spark, sf))


@query("q_facility_daily_summary", f"SELECT facility_id, delivery_date, {_METRICS} FROM ({DELIVERIES}) WHERE delivery_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' GROUP BY ALL")
def _(spark, sf):
    return operations.facility_metrics(views.deliveries(spark, sf), first="1995-01-01", last="1996-12-31")


@query("q_platform_daily", f"SELECT delivery_date, count(DISTINCT shipment_id) AS shipments, {_METRICS} FROM ({DELIVERIES}) GROUP BY ALL")
def _(spark, sf):
    return operations.platform_daily(views.deliveries(spark, sf))


@query("q_carrier_performance", f"SELECT carrier_id, {_METRICS}, round(avg(attempt_count), 6) AS avg_attempts FROM ({DELIVERIES}) GROUP BY carrier_id ORDER BY total_deliveries DESC, carrier_id LIMIT 10")
def _(spark, sf):
    return operations.carrier_performance(views.deliveries(spark, sf))


@query("q_regional_summary", f"SELECT region_id, count(DISTINCT facility_id) AS facilities, {_METRICS} FROM ({DELIVERIES}) GROUP BY region_id")
def _(spark, sf):
    return operations.regional_summary(views.deliveries(spark, sf))


_SHIPMENTS = f"""SELECT shipment_id, arg_max(status, (event_time, event_id)) AS status, arg_max(carrier_id, (event_time, event_id)) AS carrier_id, min(event_time) FILTER (event_type = 'shipment.created') AS created_at,
    max(event_time) FILTER (event_type = 'shipment.delivered') AS delivered_at FROM ({_SHIPMENT_FACT}) GROUP BY shipment_id"""


@query("q_list_shipments_page", f"SELECT * FROM ({_SHIPMENTS}) ORDER BY shipment_id LIMIT 20 OFFSET 20")
def _(spark, sf):
    return operations.page(operations.shipments(_shipment_facts(spark, sf)), ["shipment_id"], 2, 20)[0]


@query("q_facility_list", "SELECT concat('FAC-', n_nationkey) AS facility_id, n_name AS facility_name, concat('REG-', n_regionkey) AS region_id FROM nation")
def _(spark, sf):
    return enrich.one_per_key(views.dimensions(spark, sf)["facility"], "facility_id").select("facility_id", "facility_name", "region_id")


@query("q_multi_topic_union", f"SELECT topic, count(*) AS n FROM (SELECT 'a' AS topic FROM ({SILVER}) WHERE source_system = 'app' UNION ALL SELECT 'b' FROM ({SILVER}) WHERE source_system = 'web') GROUP BY topic")
def _(spark, sf):
    from harborline.sources import messages as m

    silver = views.silver(spark, sf)
    raw = lambda s: silver.where(F.col("source_system") == s).select(F.col("payload").cast("binary").alias("data"), F.create_map(F.lit("event_id"), "event_id").alias("attributes"))
    return m.tagged_union({"a": raw("app"), "b": raw("web")}).groupBy(F.col("attributes")["_source_topic"].alias("topic")).agg(F.count("*").alias("n"))


@query("q_distinct_tuples", f"SELECT DISTINCT facility_id, carrier_id, driver_id FROM ({SILVER})")
def _(spark, sf):
    return views.silver(spark, sf).select("facility_id", "carrier_id", "driver_id").distinct()


@query("q_silver_rows", f"SELECT event_id, dedupe_key, {_P('delivery_id')} AS delivery_id, {_P('shipment_id')} AS shipment_id, {_P('driver_id')} AS driver_id, {_P('facility_id')} AS facility_id FROM ({SILVER}) WHERE domain = 'delivery'")
def _(spark, sf):
    from harborline.sources import sinks

    rows = sinks.silver_rows(views.silver(spark, sf).where("domain = 'delivery'").select("event_id", "event_type", "event_version", "event_time", "ingest_time", "source_system", "payload", "trace_id"), "delivery")
    return rows.select("event_id", "dedupe_key", "delivery_id", "shipment_id", "driver_id", "facility_id")

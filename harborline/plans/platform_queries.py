"""Further queries of the platform's operators: filters of serving, sinks, checks by schema, the daily build; each with its SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from harborline import config, event_models, types
from harborline.functions import envelope, masking
from harborline.operators import route, validate
from harborline.plans import marts, operations, views
from harborline.plans.reference_queries import ORACLE as BASE
from harborline.plans.reference_queries import _BROKEN, _DONE_TIME, _FACT, _JS, _METRICS, _P, _SHIPMENT_FACT, _SHIPMENTS, _shipment_facts, _validated
from harborline.plans.views import AS_OF, DELIVERIES, SILVER, SILVER_DUP
from harborline.session import comparable, scratch_path, table
from harborline.sources import kafka, messages, sinks

_KEY = b"harborline test key"
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name] = lambda spark, sf: comparable(f(spark, sf))
        ORACLE[name] = sql
        return f

    return keep


def _values(rows: list[tuple], names: str) -> str:
    text = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else repr(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) t({names})"


# ---- sources -------------------------------------------------------------------------------------------------------


def _raw(df: DataFrame) -> DataFrame:
    return df.select(F.col("payload").cast("binary").alias("data"), F.create_map(F.lit("event_id"), "event_id").alias("attributes"))


@query("q_bounded_pull", f"SELECT least(count(*), 1000) AS n FROM ({SILVER})")
def _(spark, sf):
    path = scratch_path(spark, "pull")
    _raw(views.silver(spark, sf)).write.parquet(path)
    return messages.read_batch(spark, path, 1000).agg(F.count("*").alias("n"))


@query("q_kafka_messages", f"""
    SELECT event_id, CASE WHEN n % 3 = 0 THEN 'plain ' || n END AS raw_value, CASE WHEN n % 3 <> 0 THEN {_P('delivery_id')} END AS delivery_id, domain AS topic, CAST(n % 4 AS VARCHAR) AS part, CAST(n AS VARCHAR) AS pos,
           CASE WHEN n % 2 = 0 THEN event_id END AS record_key FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) AS n FROM ({SILVER}))""")
def _(spark, sf):
    n = F.substring_index("event_id", "-", -1).cast("long")
    value = F.when(n % 3 == 0, F.concat(F.lit("plain "), n)).otherwise(F.col("payload"))
    records = views.silver(spark, sf).select(
        F.when(n % 2 == 0, F.col("event_id")).otherwise("").cast("binary").alias("key"), value.cast("binary").alias("value"), F.col("domain").alias("topic"), (n % 4).cast("int").alias("partition"), n.alias("offset"), F.col("event_time").alias("timestamp"),
    )
    m, a = kafka.to_messages(records), F.col("attributes")
    body = lambda p: F.get_json_object(F.col("data").cast("string"), f"$.{p}")
    return m.select(
        F.concat(F.lit("evt-"), a["_kafka_offset"]).alias("event_id"), body("raw_value").alias("raw_value"), body("delivery_id").alias("delivery_id"), a["_kafka_topic"].alias("topic"), a["_kafka_partition"].alias("part"), a["_kafka_offset"].alias("pos"), a["_kafka_key"].alias("record_key")
    )


# ---- sinks ---------------------------------------------------------------------------------------------------------


def _envelopes(spark, sf) -> DataFrame:
    return views.silver(spark, sf).select("event_id", "event_type", "event_version", "event_time", "ingest_time", "source_system", "payload", "trace_id")


@query("q_bronze_json", f"SELECT domain, strftime(event_time, '%Y-%m-%d') AS event_date, count(*) AS n, count(DISTINCT strftime(event_time, '%H')) AS hours, min(event_id) AS least, max({_P('facility_id')}) AS most FROM ({SILVER}) GROUP BY ALL")
def _(spark, sf):
    path = scratch_path(spark, "bronze")
    sinks.bronze_json(_envelopes(spark, sf), path)
    get = lambda p: F.get_json_object("value", f"$.{p}")
    return spark.read.text(path).groupBy("domain", F.col("event_date").cast("string").alias("event_date")).agg(F.count("*").alias("n"), F.count_distinct("hour").alias("hours"), F.min(get("event_id")).alias("least"), F.max(get("payload.facility_id")).alias("most"))


@query("q_bronze_parquet", f"SELECT CAST(event_time AS DATE) AS event_date, event_id, event_type, epoch_us(ingest_time) AS ingest_time, payload FROM ({SILVER})")
def _(spark, sf):
    path = scratch_path(spark, "bronze")
    sinks.bronze_parquet(_envelopes(spark, sf), path)
    return spark.read.parquet(path).select("event_date", "event_id", "event_type", "ingest_time", "payload")


@query("q_silver_append", f"""SELECT event_id, event_type, dedupe_key, {_P('facility_id')} AS facility_id, {_P('facility_type')} AS facility_type, {_P('region_id')} AS region_id FROM ({SILVER})
    WHERE domain = 'facility' AND CAST(event_time AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""")
def _(spark, sf):
    path = scratch_path(spark, "silver")
    events = _envelopes(spark, sf).where(envelope.domain(F.col("event_type")) == "facility")
    for late in (False, True):  # two appends
        sinks.write_silver(events.where((F.dayofmonth("event_time") > 11) == late), path, "facility")
    rows = spark.read.parquet(f"{path}/facility_events").where("event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'")
    return rows.select("event_id", "event_type", "dedupe_key", "facility_id", "facility_type", "region_id")


_SILVER_SCHEMA = [(d, f.name, f.dataType.simpleString(), not f.nullable) for d in types.DOMAINS for f in types.silver(d).fields]
_COMMON_COLUMNS = "event_id:STRING,event_type:STRING,event_version:STRING,event_time:TIMESTAMP,ingest_time:TIMESTAMP,trace_id:STRING,source_system:STRING,payload:JSON,dedupe_key:STRING"
_PROMOTED = [("shipment", "shipment_id,tracking_number,carrier_id,facility_id"), ("facility", "facility_id,facility_type,region_id"), ("driver", "driver_id,carrier_id,facility_id,vehicle_id"), ("delivery", "delivery_id,shipment_id,driver_id,facility_id")]


@query("q_silver_schemas", f"SELECT domain, '{_COMMON_COLUMNS},' || array_to_string(list_transform(string_split(cols, ','), lambda c: c || ':STRING'), ',') AS columns FROM ({_values(_PROMOTED, 'domain, cols')})")
def _(spark, sf):
    return spark.createDataFrame([(d, types.schema_string(d)) for d in types.DOMAINS], "domain string, columns string")


@query("q_gold_insert", f"SELECT event_date, count(*) AS n, count(DISTINCT event_id) AS ids FROM (SELECT * FROM ({_SHIPMENT_FACT}) UNION ALL SELECT * FROM ({_SHIPMENT_FACT}) WHERE event_date >= DATE '2024-01-25') GROUP BY ALL")
def _(spark, sf):
    path, facts = scratch_path(spark, "gold"), _shipment_facts(spark, sf)
    sinks.write_gold(facts, path, "event_date")
    sinks.write_gold(facts.where("event_date < DATE '2024-01-05'"), path, "event_date")  # replaces its days
    sinks.write_gold(facts.where("event_date >= DATE '2024-01-25'"), path, "event_date", append=True)
    return spark.read.parquet(path).groupBy("event_date").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query("q_partition_delete", f"SELECT event_date, count(*) AS n FROM ({_SHIPMENT_FACT}) WHERE event_date >= DATE '2024-01-15' GROUP BY ALL")
def _(spark, sf):
    path = scratch_path(spark, "gold")
    sinks.write_gold(_shipment_facts(spark, sf), path, "event_date")
    sinks.delete_rows(spark, path, "event_date", "2024-01-15")
    return spark.read.parquet(path).groupBy("event_date").agg(F.count("*").alias("n"))


_FACT_BY_DATE = _FACT.replace("PARTITION BY d, delivery_id", "PARTITION BY delivery_id").replace("SELECT d, delivery_id, min(event_time)", "SELECT delivery_id, min(event_time)").replace("USING (d, delivery_id)", "USING (delivery_id)")
_REPAIRED = "delivery_date IN (DATE '2024-01-20', DATE '2024-01-28')"


@query("q_late_repair", f"""SELECT delivery_id, delivery_date, CASE WHEN {_REPAIRED} THEN 'rebuilt' ELSE 'old' END AS state FROM ({_FACT_BY_DATE})""")
def _(spark, sf):
    path = scratch_path(spark, "gold")
    events = views.silver(spark, sf).where("domain = 'delivery'")
    old = marts.fact_deliveries(events, by_delivery_date=True).withColumn("status", F.lit("old"))
    wrong = old.unionByName(old.where("delivery_date = DATE '2024-01-20'"))  # a day with its rows twice
    sinks.write_gold(wrong, path, "delivery_date")
    dates = spark.createDataFrame([(dt.date(2024, 1, 20),), (dt.date(2024, 1, 28),)], "event_date date")
    operations.repair(spark, path, events, dates)
    return spark.read.schema(old.schema).parquet(path).select("delivery_id", "delivery_date", F.when(F.col("status") == "old", "old").otherwise("rebuilt").alias("state"))


@query("q_dead_letter_body", f"""SELECT n, event_id, event_type, {_P('delivery_id')} AS delivery_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS event_time
    FROM ({_BROKEN}) WHERE n IN (SELECT n FROM ({BASE['q_validation_error_codes']}))""")
def _(spark, sf):
    _, invalid = validate.split(_validated(spark, sf))
    bodies = route.dead_letters(invalid).select(F.col("data").cast("string").alias("body"), F.col("attributes")["event_id"].alias("id"))
    get = lambda p: F.get_json_object("body", f"$.{p}")
    rows = bodies.select(get("event_id").alias("event_id"), get("event_type").alias("event_type"), get("payload.delivery_id").alias("delivery_id"), F.substring(get("event_time"), 1, 19).alias("event_time"))
    numbered = _validated(spark, sf).where("size(errors) > 0").select("n", "event_id", "event_type", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time"))
    return numbered.join(rows, ["event_id", "event_type", "event_time"]).dropDuplicates(["n"])


# ---- masks, small functions -----------------------------------------------------------------------------------------


@query("q_mask_payload", f"""SELECT event_id, {_P('facility_id')} AS facility_id,
    array_to_string(list_transform(string_split({_P('carrier_name')}, ' '), lambda w: CASE WHEN length(w) > 1 THEN w[1] || repeat('*', length(w) - 1) ELSE w END), ' ') AS carrier_name,
    'n***@m***.*' AS email, '***-***-' || right(lpad(CAST(n AS VARCHAR), 6, '0'), 4) AS phone, CAST(n AS VARCHAR) AS kept, NULL AS removed FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) AS n FROM ({SILVER}))""")
def _(spark, sf):
    n = F.substring_index("event_id", "-", -1)
    nested = F.to_json(F.struct(F.parse_json("payload").alias("outer"), F.array(F.struct(F.lit("nn@mail.x").alias("email"), F.struct(F.lpad(n, 6, "0").alias("phone")).alias("contact"))).alias("people"), n.alias("count"), F.lit("x").alias("secret")))
    rows = views.silver(spark, sf).select("event_id", masking.mask_payload(nested, remove={"secret"}).alias("p"))
    get = lambda p: F.get_json_object("p", f"$.{p}")
    return rows.select("event_id", get("outer.facility_id").alias("facility_id"), get("outer.carrier_name").alias("carrier_name"), get("people[0].email").alias("email"), get("people[0].contact.phone").alias("phone"), get("count").alias("kept"), get("secret").alias("removed"))


@query("q_personal_fields", f"""SELECT field, field LIKE '%\\_name' ESCAPE '\\' OR field LIKE '%email%' OR field LIKE '%phone%' OR field LIKE '%address%' OR field LIKE '%ssn%' OR field LIKE '%license%'
    OR field IN ('name', 'street', 'social_security_number', 'credit_card', 'bank_account', 'signed_by') AS personal FROM ({_values([(f,) for t in sorted(event_models.EVENTS) for f in sorted(event_models.schemas(t)[t]['properties'])], 'field')}) GROUP BY field""")
def _(spark, sf):
    names = sorted({f for t in event_models.EVENTS for f in event_models.schemas(t)[t]["properties"]})
    return spark.createDataFrame([(f, masking.is_personal(f)) for f in names], "field string, personal boolean")


@query("q_dimensional_weight", "SELECT p_partkey, CAST(p_size * (p_size + 1) * 2.5 AS DOUBLE) AS volume_cm3, round(CAST(p_size * (p_size + 1) * 2.5 / 5000 AS DOUBLE), 6) AS weight_kg FROM part")
def _(spark, sf):
    size = F.col("p_size").cast("double")
    sides = (size, size + 1, F.lit(2.5))
    return table(spark, sf, "part").select("p_partkey", envelope.volume_cm3(*sides).alias("volume_cm3"), envelope.dimensional_weight_kg(*sides).alias("weight_kg"))


_PARAMETERS = [("flag", True, "boolean"), ("count", 3, "bigint"), ("share", 0.5, "double"), ("moment", dt.datetime(2024, 1, 2, 3), "timestamp"), ("day", dt.date(2024, 1, 2), "date"), ("text", "a", "string"), ("list", ["a"], "string")]


@query("q_parameter_types", _values([(n, t) for n, _, t in _PARAMETERS], "name, type"))
def _(spark, sf):
    return spark.createDataFrame([(n, envelope.literal_type(v).simpleString()) for n, v, _ in _PARAMETERS], "name string, type string")


@query("q_config_merge", _values([("a.x", "1"), ("a.y", "from-env/tail"), ("a.z.deep", "new"), ("b", "[2]"), ("c", "fallback")], "path, value"))
def _(spark, sf):
    merged = config.merge({"a": {"x": 1, "y": "old", "z": {"deep": "old"}}, "b": [1, 3]}, {"a": {"y": "${NAME}/tail", "z": {"deep": "new"}}, "b": [2], "c": "${ABSENT:-fallback}"})
    out: list[tuple[str, str]] = []

    def walk(prefix, o):
        for k, v in o.items():
            walk(f"{prefix}{k}.", v) if isinstance(v, dict) else out.append((prefix + k, str(v)))

    walk("", config.substitute(merged, {"NAME": "from-env"}))
    return spark.createDataFrame(out, "path string, value string")


@query("q_table_name", _values([("`p`.`d`.`t`",)], "name"))
def _(spark, sf):
    return spark.createDataFrame([(operations.table_name("p", "d", "t"),)], "name string")


@query("q_execute", f"SELECT source_system, count(*) AS n FROM ({SILVER}) WHERE domain = 'driver' AND attempt >= 2 GROUP BY ALL".replace("attempt >= 2", f"CAST({_P('attempt_count')} AS BIGINT) >= 2"))
def _(spark, sf):
    views.silver(spark, sf).createOrReplaceTempView("harborline_silver")
    rows = operations.execute(spark, "SELECT source_system, count(*) AS n FROM harborline_silver WHERE domain = :domain AND CAST(get_json_object(payload, '$.attempt_count') AS BIGINT) >= :least GROUP BY source_system", domain="driver", least=2)
    return spark.createDataFrame([(r["source_system"], r["n"]) for r in rows], "source_system string, n bigint")


@query("q_observed_counts", f"""SELECT count(*) AS rows, count(*) FILTER (domain = 'driver') AS drivers, min(attempts) AS least, max(attempts) AS most, CAST(sum(attempts) AS BIGINT) AS total, count(attempts) AS counted
    FROM (SELECT *, CAST({_P('attempt_count')} AS BIGINT) AS attempts FROM ({SILVER}))""")
def _(spark, sf):
    from harborline.streaming import metrics

    counts, spread = Observation("counts"), Observation("spread")
    rows = views.silver(spark, sf).withColumn("attempts", F.get_json_object("payload", "$.attempt_count").cast("long"))
    watched = metrics.distribution(metrics.counted(rows, counts, drivers=F.col("domain") == "driver"), spread, "attempts")
    watched.write.format("noop").mode("overwrite").save()
    a, b = counts.get, spread.get
    return spark.createDataFrame([(a["rows"], a["drivers"], b["min"], b["max"], b["sum"], b["count"])], "rows bigint, drivers bigint, least bigint, most bigint, total bigint, counted bigint")


# ---- schemas -------------------------------------------------------------------------------------------------------


def _errors(events: DataFrame, schemas: dict) -> DataFrame:
    errors = validate.validated(events, schemas).select("event_id", F.explode("errors").alias("e")).where("e.error_code = 'SCHEMA_VIOLATION'")
    return errors.groupBy("event_id", F.col("e.field").alias("field")).agg(F.count("*").alias("n"))


@query("q_schema_check_shipment", f"""SELECT event_id, field, count(*) AS n FROM (
    SELECT event_id, unnest(list_filter([CASE WHEN n % 4 = 0 THEN 'tracking_number' END, CASE WHEN n % 6 = 1 THEN 'service_level' END, CASE WHEN n % 10 = 2 THEN 'declared_value_cents' END, CASE WHEN n % 15 = 4 THEN 'origin.postal_code' END, 'root'], lambda f: f IS NOT NULL)) AS field
    FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) AS n FROM ({SILVER}) WHERE event_type = 'shipment.created')) GROUP BY ALL""")
def _(spark, sf):
    schema = {
        "$schema": "http://json-schema.org/draft-07/schema#", "title": "created", "type": "object", "required": ["shipment_id", "tracking_number", "sender"],
        "properties": {
            "shipment_id": {"type": "string"}, "tracking_number": {"type": "string", "minLength": 4, "maxLength": 30}, "service_level": {"type": "string", "enum": ["ground", "express"]},
            "declared_value_cents": {"type": ["integer", "null"], "minimum": 0}, "origin": {"$ref": "#/definitions/address"},
        },
        "definitions": {"address": {"type": "object", "properties": {"postal_code": {"type": "string", "pattern": "^[0-9A-Z -]+$"}}}},
    }
    n = F.substring_index("event_id", "-", -1).cast("long")
    body = F.to_json(F.struct(
        F.lit("S").alias("shipment_id"), F.when(n % 4 == 0, "T1").otherwise("T1000").alias("tracking_number"), F.when(n % 6 == 1, "slow").otherwise("ground").alias("service_level"),
        F.when(n % 10 == 2, -1.0).otherwise(F.when(n % 2 == 0, 5.0)).alias("declared_value_cents"), F.struct(F.when(n % 15 == 4, "?").otherwise("A 1").alias("postal_code")).alias("origin"),
    ))
    return _errors(views.silver(spark, sf).where("event_type = 'shipment.created'").withColumn("payload", body), {"shipment.created": schema})


@query("q_schema_check_delivery", f"""SELECT event_id, field, count(*) AS n FROM (
    SELECT event_id, unnest(list_filter([CASE WHEN n % 6 NOT IN (0, 1, 2, 5) THEN 'code' END, CASE WHEN n % 10 = 2 THEN 'at.latitude' END, CASE WHEN n % 7 = 0 THEN 'attempts' END, CASE WHEN n % 11 = 5 THEN 'root' END], lambda f: f IS NOT NULL)) AS field
    FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) AS n FROM ({SILVER}) WHERE event_type = 'delivery.completed')) GROUP BY ALL""")
def _(spark, sf):
    schema = {
        "type": "object", "required": ["attempts"],
        "properties": {
            "code": {"enum": [1, 2.5, True, None, "x"]}, "attempts": {"type": "integer", "exclusiveMinimum": 0}, "at": {"type": "object", "properties": {"latitude": {"type": "number", "minimum": -90, "maximum": 90}}},
        },
    }
    n = F.substring_index("event_id", "-", -1).cast("long")
    # by n % 6: 1, true, null, "1", false, 2.50
    code = F.element_at(F.array(*[F.lit(x) for x in ("1", "true", "null", '"1"', "false", "2.50")]), (n % 6 + 1).cast("int"))
    attempts = F.when(n % 11 == 5, "").otherwise(F.when(n % 7 == 0, ',"attempts":0').otherwise(',"attempts":2.0'))
    body = F.concat(F.lit('{"code":'), code, attempts, F.lit(',"at":{"latitude":'), F.when(n % 10 == 2, "90.5").otherwise("-90"), F.lit("}}"))
    # a missing field has no value that could be too small
    return _errors(views.silver(spark, sf).where("event_type = 'delivery.completed'").withColumn("payload", body), {"delivery": schema})


ORACLE["q_schema_check_delivery"] = ORACLE["q_schema_check_delivery"].replace("CASE WHEN n % 7 = 0 THEN 'attempts' END", "CASE WHEN n % 7 = 0 AND n % 11 <> 5 THEN 'attempts' END")

# How many fields each event requires
_REQUIRED = [
    ("shipment.created", 8), ("shipment.updated", 3), ("shipment.delivered", 4), ("shipment.in_transit", 3), ("shipment.cancelled", 5), ("delivery.scheduled", 7), ("delivery.started", 10), ("delivery.attempted", 7),
    ("delivery.completed", 8), ("delivery.failed", 7), ("delivery.rescheduled", 6), ("driver.created", 11), ("driver.updated", 2), ("driver.assigned", 7), ("driver.location_updated", 3), ("driver.status_changed", 3),
    ("facility.created", 5), ("facility.updated", 2), ("facility.capacity_changed", 5), ("facility.status_changed", 4),
]


@query("q_typed_events", f"""WITH m AS ({_values(_REQUIRED, 'event_type, required')})
    SELECT event_type, count(*) * required AS missing, count(*) AS mistyped FROM m, nation GROUP BY event_type, required""")
def _(spark, sf):
    schemas = event_models.schemas()
    # a required text that is a number, and the rest missing
    first = {t: next(f for f in s["required"] if s["properties"][f].get("type") == "string") for t, s in schemas.items()}
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("event_type"), F.lit('{"' + f + '": 5}').alias("wrong")) for t, f in first.items()])).alias("x")
    events = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("event_id"), F.lit("v1").alias("event_version"), each).select("event_id", "event_version", "x.*")
    bodies = events.select("event_id", "event_version", "event_type", F.explode(F.array(F.lit("{}"), "wrong")).alias("payload"))
    errors = validate.validated(bodies, schemas).select("event_type", "payload", F.explode("errors").alias("e")).where("e.error_code = 'SCHEMA_VIOLATION'")
    empty = F.col("payload") == "{}"
    return errors.groupBy("event_type").agg(F.count_if(empty).alias("missing"), F.count_if(~empty & (F.col("e.field") != "root")).alias("mistyped"))


# ---- gold ----------------------------------------------------------------------------------------------------------


def _deliveries(spark, sf):
    return views.silver(spark, sf).where("domain = 'delivery'")


@query("q_fact_deliveries_day", f"SELECT * FROM ({_FACT}) WHERE delivery_date = DATE '2024-01-11'")
def _(spark, sf):
    return marts.fact_deliveries(_deliveries(spark, sf), day="2024-01-11")


@query("q_fact_deliveries_by_date", f"SELECT * FROM ({_FACT_BY_DATE}) WHERE delivery_date = DATE '2024-01-11'")
def _(spark, sf):
    return marts.fact_deliveries(_deliveries(spark, sf), day="2024-01-11", by_delivery_date=True)


@query("q_fact_deliveries_payload_key", _FACT.replace("d, delivery_id", "d, key").replace("AS d FROM", "AS d, json_extract_string(payload, '$.delivery_id') AS key FROM"))
def _(spark, sf):
    return marts.fact_deliveries(_deliveries(spark, sf), key=F.get_json_object("payload", "$.delivery_id"))


@query("q_fact_shipment_events_day", f"SELECT * FROM ({_SHIPMENT_FACT}) WHERE event_date = DATE '2024-01-11'")
def _(spark, sf):
    return marts.fact_shipment_events(views.silver(spark, sf).where("domain = 'shipment'"), "2024-01-11")


def _with_address(spark, sf) -> DataFrame:
    """Facility events whose payload has an address, capacity and status by their number."""
    n = F.substring_index("event_id", "-", -1).cast("long")
    address = F.struct(F.concat(F.lit("Road "), n % 3).alias("street"), F.lit("Ham").alias("city"), F.when(n % 2 == 0, "NY").alias("state"), F.lit("US").alias("country"), F.lit("00100").alias("postal_code"), F.lit(1.5).alias("latitude"), (n % 2).cast("double").alias("longitude"))
    body = F.to_json(F.struct(F.get_json_object("payload", "$.facility_name").alias("facility_name"), F.lit("hub").alias("facility_type"), address.alias("address"), F.lit("UTC").alias("timezone"), (n % 4).alias("capacity_units"), F.when(n % 5 > 0, F.when(n % 5 == 1, "closed").otherwise("active")).alias("status")))
    return views.silver(spark, sf).where("domain = 'facility'").withColumn("payload", body)


@query("q_facility_tuples", f"""SELECT facility_id, {_P('facility_name')} AS facility_name, 'hub' AS facility_type, 'Road ' || (n % 3) AS address, 'Ham' AS city, CASE WHEN n % 2 = 0 THEN 'NY' END AS state, 'US' AS country, '00100' AS postal_code,
    CAST(1.5 AS DOUBLE) AS latitude, CAST(n % 2 AS DOUBLE) AS longitude, 'UTC' AS timezone, n % 4 AS capacity_units, n % 5 <> 1 AS is_active, epoch_us(max(event_time)) AS last_updated
    FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) AS n FROM ({SILVER}) WHERE domain = 'facility') GROUP BY ALL""")
def _(spark, sf):
    return marts.facility_tuples(_with_address(spark, sf))


_HALVES = """o AS (SELECT facility_id, arg_max(nm, (u, nm)) AS n, max(u) AS u FROM t WHERE u < TIMESTAMP '2024-01-15' GROUP BY facility_id), s AS (SELECT * FROM t WHERE u >= TIMESTAMP '2024-01-15'),
    t AS (SELECT facility_id, nm, max(event_time) AS u FROM x GROUP BY facility_id, nm, event_time >= TIMESTAMP '2024-01-15')"""


@query("q_scd2_merge_tuples", f"""
    WITH x AS (SELECT facility_id, {_P('facility_name')} AS nm, event_time FROM ({SILVER}) WHERE domain = 'facility' AND facility_id <> 'FAC-3' OR domain = 'facility' AND event_time >= TIMESTAMP '2024-01-15'),
         t AS (SELECT facility_id, nm, event_time < TIMESTAMP '2024-01-15' AS early, max(event_time) AS u FROM x GROUP BY ALL), o AS (SELECT facility_id, arg_max(nm, u) AS nm, max(u) AS u FROM t WHERE early GROUP BY facility_id),
         s AS (SELECT * FROM t WHERE NOT early), c AS (SELECT facility_id, max(s.u) AS closed FROM o JOIN s USING (facility_id) WHERE s.nm <> o.nm GROUP BY facility_id)
    SELECT facility_id, nm AS facility_name, epoch_us(u) AS effective_from, epoch_us(closed) AS effective_to, closed IS NULL AS is_current FROM o LEFT JOIN c USING (facility_id)
    UNION ALL SELECT facility_id, nm, epoch_us(u), NULL, true FROM s WHERE facility_id NOT IN (SELECT facility_id FROM o)""")
def _(spark, sf):
    # the plain mode with several tuples of a facility: each is compared, each unmatched one inserted
    events = views.silver(spark, sf).where("domain = 'facility'")
    tuples = lambda when: events.where(when).groupBy("facility_id", F.get_json_object("payload", "$.facility_name").alias("facility_name")).agg(F.max("event_time").alias("last_updated"))
    early = tuples("event_time < TIMESTAMP '2024-01-15' AND facility_id <> 'FAC-3'")
    dim = marts.merge_history(spark.createDataFrame([], types.GOLD["dim_facility"]), early, "facility_id", ["facility_name"], full=True)
    merged = marts.merge_history(dim, tuples("event_time >= TIMESTAMP '2024-01-15'"), "facility_id", ["facility_name"])
    return merged.select("facility_id", "facility_name", "effective_from", "effective_to", "is_current")


@query("q_carrier_insert_more", f"""
    WITH x AS (SELECT carrier_id, event_time, event_time < TIMESTAMP '2024-01-15' AND carrier_id <> 'CAR-2' AS early FROM ({SILVER}) WHERE domain = 'shipment' AND (event_time >= TIMESTAMP '2024-01-15' OR carrier_id <> 'CAR-2'))
    SELECT carrier_id, epoch_us(CASE WHEN bool_or(early) THEN max(event_time) FILTER (early) ELSE max(event_time) END) AS effective_from, true AS is_current FROM x GROUP BY carrier_id""")
def _(spark, sf):
    events = views.silver(spark, sf).where("domain = 'shipment'")
    merge = lambda dim, when: marts.merge_history(dim, marts.carrier_tuples(events.where(when)), "carrier_id", [], close=False)
    dim = merge(spark.createDataFrame([], types.GOLD["dim_carrier"]), "event_time < TIMESTAMP '2024-01-15' AND carrier_id <> 'CAR-2'")
    return merge(dim, "event_time >= TIMESTAMP '2024-01-15'").select("carrier_id", "effective_from", "is_current")


@query("q_dim_driver", f"""
    WITH x AS (SELECT concat('DRV-', s_suppkey) AS driver_id, concat('driver ', lower(s_name)) AS name, s_suppkey % 3 AS k FROM supplier)
    SELECT driver_id, 'tok_' || left(sha256(unhex('{bytes(b ^ 0x5C for b in _KEY.ljust(64, bytes(1))).hex()}') || unhex(sha256(unhex('{bytes(b ^ 0x36 for b in _KEY.ljust(64, bytes(1))).hex()}') || encode(':' || name)))), 16) AS driver_name_hash,
           'CAR-1' AS carrier_id, CASE WHEN k = 0 THEN 'FAC-1' END AS home_facility_id, k <> 2 AS is_active, {int(dt.datetime(2024, 1, 3, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000} AS effective_from, true AS is_current FROM x""")
def _(spark, sf):
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey") % 3
    body = F.to_json(F.struct(F.concat(F.lit("DRV-"), "s_suppkey").alias("driver_id"), F.lit("Driver").alias("first_name"), F.col("s_name").alias("last_name"), F.lit("CAR-1").alias("carrier_id"), F.when(k == 0, "FAC-1").alias("home_facility_id"), F.when(k == 2, "unavailable").when(k == 1, "on_route").alias("status")))
    events = s.select(body.alias("payload"), F.lit("2024-01-03").cast("timestamp").alias("event_time"))
    out = marts.merge_history(spark.createDataFrame([], types.GOLD["dim_driver"]), marts.driver_tuples(events, _KEY), "driver_id", ["driver_name_hash", "carrier_id", "home_facility_id", "is_active"], full=True)
    return out.select("driver_id", "driver_name_hash", "carrier_id", "home_facility_id", "is_active", "effective_from", "is_current")


@query("q_daily_build", f"""
    SELECT 'fact_deliveries' AS part, CAST(delivery_date AS VARCHAR) AS day, count(*) AS n, NULL AS current FROM ({_FACT}) WHERE delivery_date BETWEEN DATE '2024-01-11' AND DATE '2024-01-12' GROUP BY ALL
    UNION ALL SELECT 'fact_shipment_events', CAST(event_date AS VARCHAR), count(*), NULL FROM ({_SHIPMENT_FACT}) WHERE event_date BETWEEN DATE '2024-01-11' AND DATE '2024-01-12' GROUP BY ALL
    UNION ALL SELECT 'dim_carrier', NULL, count(DISTINCT carrier_id), count(DISTINCT carrier_id) FROM ({_SHIPMENT_FACT}) WHERE event_date BETWEEN DATE '2024-01-11' AND DATE '2024-01-12'
    UNION ALL SELECT 'checks', NULL, 6, 6""")
def _(spark, sf):
    out, events, checks = scratch_path(spark, "build"), views.silver(spark, sf), []
    for day in ("2024-01-11", "2024-01-12", "2024-01-12"):  # a day built twice replaces itself
        checks.append(marts.build_day(spark, out, events, day, attempts=lambda task: operations.retried(task, wait_s=0)))
    days = lambda name, by: spark.read.parquet(f"{out}/{name}").groupBy(F.lit(name).alias("part"), F.col(by).cast("string").alias("day")).agg(F.count("*").alias("n")).withColumn("current", F.lit(None).cast("bigint"))
    dim = spark.read.schema(types.GOLD["dim_carrier"]).parquet(f"{out}/dim_carrier/as_of=2024-01-12").select(F.lit("dim_carrier").alias("part"), F.lit(None).cast("string").alias("day"), "is_current")
    dim = dim.groupBy("part", "day").agg(F.count("*").alias("n"), F.count_if("is_current").alias("current"))
    last = spark.createDataFrame([("checks", None, len(checks[-1]), sum(checks[-1].values()))], "part string, day string, n bigint, current bigint")
    return days("fact_deliveries", "delivery_date").unionByName(days("fact_shipment_events", "event_date")).unionByName(dim).unionByName(last)


@query("q_sla_dead_letters", f"SELECT count(*) AS dead_letters, count(*) = 0 AS dead_letters_ok FROM ({SILVER}) WHERE CAST(substr(event_id, 5) AS BIGINT) % 100 = 3")
def _(spark, sf):
    silver = views.silver(spark, sf)
    dead = silver.where(F.substring_index("event_id", "-", -1).cast("long") % 100 == 3)
    return operations.sla_report(silver, marts.fact_deliveries(_deliveries(spark, sf)), AS_OF, dead=dead).select("dead_letters", "dead_letters_ok")


# ---- serving -------------------------------------------------------------------------------------------------------


@query("q_timeline_one", f"SELECT shipment_id, event_id, event_type, event_time, facility_id, status FROM ({_SHIPMENT_FACT}) WHERE shipment_id = 'SHP-7'")
def _(spark, sf):
    return operations.timeline(_shipment_facts(spark, sf), "SHP-7").drop("location")


@query("q_shipment_events_limit", f"SELECT event_id FROM ({_SHIPMENT_FACT}) WHERE shipment_id = 'SHP-7' ORDER BY event_time, event_id LIMIT 5")
def _(spark, sf):
    return operations.shipment_events(_shipment_facts(spark, sf), "SHP-7", 5).select("event_id")


@query("q_shipment_one", f"SELECT * FROM ({_SHIPMENTS}) WHERE shipment_id = 'SHP-7'")
def _(spark, sf):
    return operations.shipments(_shipment_facts(spark, sf), shipment_id="SHP-7")


@query("q_shipments_filtered", f"SELECT * FROM ({_SHIPMENTS}) WHERE carrier_id IN ('CAR-1') AND make_timestamp(created_at) >= TIMESTAMP '2024-01-01' AND make_timestamp(created_at) < TIMESTAMP '2024-01-04'")
def _(spark, sf):
    return operations.shipments(_shipment_facts(spark, sf), carrier="CAR-1", first="2024-01-01", last="2024-01-03")


@query("q_shipments_total", f"SELECT count(*) AS total, 20 AS shown FROM ({_SHIPMENTS})")
def _(spark, sf):
    rows, total = operations.page(operations.shipments(_shipment_facts(spark, sf)), ["shipment_id"], 1, 20)
    return rows.agg(F.count("*").alias("shown")).select(F.lit(total).cast("bigint").alias("total"), "shown")


ORACLE["q_shipments_total"] = f"SELECT count(*) AS total, least(count(*), 20) AS shown FROM ({_SHIPMENTS})"


@query("q_facilities_filtered", "SELECT concat('FAC-', n_nationkey) AS facility_id, n_name AS facility_name FROM nation WHERE n_regionkey = 1 AND n_nationkey % 3 <> 0")
def _(spark, sf):
    n = F.substring_index("facility_id", "-", -1).cast("long")
    dim = views.dimensions(spark, sf)["facility"].withColumns({"is_active": n % 3 != 0, "is_current": F.lit(True)})
    stale = dim.withColumns({"is_current": F.lit(False), "facility_name": F.lit("old")})
    return operations.facilities(dim.unionByName(stale), kind="hub", active=True, region="REG-1").select("facility_id", "facility_name")


@query("q_facility_one", "SELECT concat('FAC-', n_nationkey) AS facility_id, n_name AS facility_name FROM nation WHERE n_nationkey = 4")
def _(spark, sf):
    return operations.facilities(views.dimensions(spark, sf)["facility"], "FAC-4").select("facility_id", "facility_name")


@query("q_facility_day", f"SELECT total_deliveries, on_time_deliveries, total_attempts FROM (SELECT {_METRICS} FROM ({DELIVERIES}) WHERE facility_id = 'FAC-1' AND delivery_date = DATE '1996-03-01') WHERE total_deliveries > 0")
def _(spark, sf):
    row = operations.facility_day(views.deliveries(spark, sf), "FAC-1", as_of="1996-03-02 05:00:00")
    names = ["total_deliveries", "on_time_deliveries", "total_attempts"]
    return spark.createDataFrame([tuple(row[n] for n in names)] if row else [], ", ".join(f"{n} bigint" for n in names))


@query("q_platform_daily_failed", f"""
    WITH d AS (SELECT delivery_date, count(DISTINCT shipment_id) AS shipments, count(*) AS total_deliveries FROM ({_FACT}) GROUP BY ALL),
         f AS (SELECT CAST(event_time AS DATE) AS delivery_date, count(DISTINCT delivery_id) AS failed_deliveries FROM ({SILVER}) WHERE event_type = 'delivery.attempted' GROUP BY ALL)
    SELECT delivery_date, coalesce(shipments, 0) AS shipments, coalesce(total_deliveries, 0) AS total_deliveries, coalesce(failed_deliveries, 0) AS failed_deliveries FROM d FULL JOIN f USING (delivery_date)""")
def _(spark, sf):
    events = _deliveries(spark, sf)
    failed = events.withColumn("event_type", F.when(F.col("event_type") == "delivery.attempted", "delivery.failed").otherwise(F.col("event_type")))
    return operations.platform_daily(marts.fact_deliveries(events), failed).select("delivery_date", "shipments", "total_deliveries", "failed_deliveries")


@query("q_dedupe_key_silver", f"SELECT dedupe_key, count(*) AS copies FROM ({SILVER_DUP}) GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf):
    return views.silver_dup(spark, sf).groupBy("dedupe_key").agg(F.count("*").alias("copies")).where("copies > 1")

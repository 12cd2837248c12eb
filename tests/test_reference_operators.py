"""The platform's operators on literals."""

import datetime as dt
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from harborline import config, types
from harborline.functions import envelope, jsontext, masking
from harborline.operators import enrich, lookup, normalize, route, validate, windows
from harborline.plans import marts, operations
from harborline.session import scratch_path
from harborline.sources import kafka, messages, sinks
from harborline.streaming import pipeline, state
from harborline.streaming.metrics import Metrics

NOW = dt.datetime(2025, 1, 1, 12)


def column(spark, values, f):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r[0] for r in df.orderBy("n").select(f(F.col("v"))).collect()]


def msgs(spark, *bodies, attributes=None):
    rows = [(b if isinstance(b, (bytes, type(None))) else b.encode() if isinstance(b, str) else json.dumps(b).encode(), attributes, "clash") for b in bodies]
    return spark.createDataFrame(rows, "data binary, attributes map<string,string>, event_id string")


def norm(spark, *bodies, attributes=None):
    return normalize.normalize(msgs(spark, *bodies, attributes=attributes), F.lit(NOW), F.lit("new")).collect()


def test_masks(spark):
    assert column(spark, ["ann@mail.example.com", "no", "", "a@b.co", "a@b@c.de", "@x.yy", None], lambda c: masking.mask_value("email", c)) == ["a***@m***.e******.c**", "***@***.***", "***@***.***", "a***@*.c*", "a***@*.d*", "***@*.y*", None]
    assert column(spark, ["+1 (555) 123-4567", "123", ""], masking.mask_phone) == ["***-***-4567", "***-***-****", "***-***-****"]
    assert column(spark, ["Ann  B Lee", "", "  "], masking.mask_name) == ["A** B L**", "***", ""]
    assert column(spark, ["12 Main St Apt 4", "5", ""], masking.mask_address) == ["1* M*** S* ***", "* ***", "*** **** ***"]
    assert column(spark, ["abc", "", "secret"], masking.mask_generic) == ["***", "***", "s****t"]


@pytest.mark.parametrize("key", [b"k", b"x" * 100])
def test_token_is_hmac(spark, key):
    want = "tok_" + hmac.new(key, b"salt:v\xc3\xa4l", hashlib.sha256).hexdigest()[:16]
    assert column(spark, ["väl", "", None], lambda c: masking.token(c, key, "salt")) == [want, "", None]


def test_personal_names_and_payloads(spark):
    assert masking.is_personal("First_Name") and masking.is_personal("workEmail") and not masking.is_personal("status")
    payload = {"name": "Ann Lee", "address": {"city": "X", "street": "1 A St"}, "tags": ["a@b.c"], "people": [{"email": "a@b.cc", "n": 1.5}, 3], "phone": 5551234, "ssn": None, "ok": True}
    got = json.loads(column(spark, [json.dumps(payload)], masking.mask_payload)[0])
    assert got == {"name": "A** L**", "address": {"city": "X", "street": "* * S* ***"}, "tags": ["a@b.c"], "people": [{"email": "a***@*.c*", "n": 1.5}, 3], "phone": "***-***-1234", "ssn": None, "ok": True}
    assert column(spark, ["not json", "[1]", None], masking.mask_payload) == ["not json", "[1]", None]
    df = spark.createDataFrame([(("Ann Lee", [("x@y.zz", 1)]), "keep")], "who struct<full_name: string, mails: array<struct<email: string, n: int>>>, status string")
    assert df.select(*masking.mask_struct(df.schema)).first().asDict(True) == {"who": {"full_name": "A** L**", "mails": [{"email": "x***@*.z*", "n": 1}]}, "status": "keep"}


def test_normalize_aliases(spark):
    a, b, c, d, e = norm(spark, {"eventId": "1", "type": "x.y", "version": "v9", "created_at": "2025-01-01T00:00:00Z", "origin": "o", "correlation_id": "t", "data": {"k": 1}}, {"id": None, "deliveryId": 1, "timestamp": 0, "occurred_at": 60, "note": "n"}, "no json", "[1]", b"\xff\xfe")
    assert (a.event_id, a.event_type, a.event_version, a.event_time, a.source_system, a.trace_id, a.payload) == ("1", "x.y", "v9", dt.datetime(2025, 1, 1), "o", "t", '{"k":1}')
    assert (b.event_id, b.event_type, b.event_time, json.loads(b.payload)) == ("None", "delivery.unknown", dt.datetime(1970, 1, 1, 0, 1), {"deliveryId": 1, "note": "n"})
    assert (c.event_id, c.event_type, c.event_version, c.source_system, c.trace_id, c.event_time, c.payload) == ("new", "unknown", "v1", "unknown", None, NOW, '{"raw_data":"no json"}')
    assert d.payload == '{"raw_data":"[1]"}' and e.payload == '{"raw_data":"FFFE"}'


def test_normalize_attributes_and_times(spark):
    (a,) = norm(spark, {"payload": [1], "event_time": "never", "timestamp": 60}, attributes={"event_id": "A", "X-Trace-Id": "t"})
    assert (a.event_id, a.trace_id, a.event_time) == ("A", "t", NOW)  # the first truthy alias counts, read or not
    assert norm(spark, None)[0].payload is not None and normalize.normalize(msgs(spark), F.lit(NOW)).count() == 0


def test_envelope_codec(spark):
    df = normalize.normalize(msgs(spark, {"event_id": "1", "type": "a.b", "event_time": "2025-01-01T00:00:00Z", "payload": {"x": 1}}), F.lit(NOW))
    assert normalize.from_json_line(normalize.to_json_line(df)).collect() == df.collect()
    got = spark.createDataFrame([("a.b.c", "1"), ("a", "1"), ("a.", "1")], "t string, i string").select(envelope.domain(F.col("t")), envelope.action(F.col("t")), envelope.dedupe_key(F.col("t"), F.col("i"))).collect()
    assert [tuple(r) for r in got] == [("a", "b", "a.b.c:1"), ("a", "unknown", "a:1"), ("a", "", "a.:1")]


SCHEMA = {
    "type": "object", "required": ["id"],
    "properties": {"id": {"type": "string", "pattern": "^[A-Z]+$"}, "n": {"type": "integer", "minimum": 1}, "p": {"$ref": "#/definitions/p"}, "e": {"enum": ["a", "b"]}, "s": {"type": "string", "maxLength": 3}},
    "definitions": {"p": {"type": "object", "required": ["x"], "properties": {"x": {"type": "number", "exclusiveMinimum": 0, "maximum": 9}}}},
}


@pytest.mark.parametrize(
    ("payload", "fields"),
    [
        ({"id": "A", "n": 2.0, "p": {"x": 1}, "e": "a", "s": "abc"}, []), ({}, ["root"]), ({"id": 5}, ["id"]), ({"id": "a"}, ["id"]), ({"id": "A", "n": 1.5}, ["n"]), ({"id": "A", "n": 0}, ["n"]), ({"id": "A", "n": True}, ["n"]),
        ({"id": "A", "p": {}}, ["p"]), ({"id": "A", "p": {"x": 0}}, ["p.x"]), ({"id": "A", "p": {"x": 10}}, ["p.x"]), ({"id": "A", "p": [1]}, ["p"]), ({"id": "A", "e": "c"}, ["e"]), ({"id": "A", "e": 1}, ["e"]), ({"id": "A", "s": "abcd"}, ["s"]),
        ({"id": None}, ["id"]), ({"id": "A", "more": {"deep": 1}}, []),
    ],
)
def test_json_schema(spark, payload, fields):
    df = spark.createDataFrame([("1", "x.y", "v1", json.dumps(payload))], "event_id string, event_type string, event_version string, payload string")
    errors = validate.validated(df, {"x": SCHEMA}).first().errors
    assert [e.field for e in errors] == fields and all(e.error_code == "SCHEMA_VIOLATION" for e in errors)


def test_envelope_and_domain_rules(spark):
    rows = [("", "shipment.x", "{}"), ("1", "", "{}"), ("1", "shipment", '{"shipmentId":null}'), (None, None, None), ("1", "driver.x", '{"driver_id":1}')]
    df = spark.createDataFrame([(i, t, "v1", p) for i, t, p in rows], "event_id string, event_type string, event_version string, payload string")
    got = [[(e.field, e.error_code) for e in r.errors] for r in validate.validated(df).collect()]
    assert got == [
        [("event_id", "REQUIRED_FIELD"), ("shipment_id", "MISSING_DOMAIN_FIELD")], [("event_type", "REQUIRED_FIELD")], [("event_type", "INVALID_FORMAT")],
        [("event_id", "REQUIRED_FIELD"), ("event_type", "REQUIRED_FIELD")], [],
    ]


def test_schema_choice(spark):
    df = spark.createDataFrame([("1", "a.b", v, "{}") for v in ("v1", "v2")] + [("1", "a.c", "v1", "{}")], "event_id string, event_type string, event_version string, payload string")
    need = lambda k: {"type": "object", "required": [k]}
    got = [r.errors[0].message for r in validate.validated(df, {"a.b_v2": need("two"), "a.b": need("one"), "a": need("any")}).collect()]
    assert got == ["'one' is required", "'two' is required", "'any' is required"]


def test_routes(spark):
    df = spark.createDataFrame([("shipment.created",), ("driver.location_updated",), ("x.y",), (None,)], "event_type string")
    assert [r.route for r in route.with_route(df).collect()] == ["shipment", "driver", "other", "other"]
    assert [r.priority for r in route.with_priority(df).collect()] == ["high", "low", "normal", "normal"]
    assert route.only_types(df, ["x.y"]).count() == 1 and route.only_types(df, []).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_lookup_broadcast_and_salted(spark, limit):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", 1), ("b", 2), (None, 9)], "k string, v int")
    out = lookup.lookup(left, dim, "k", "id", limit=limit, salts=3)
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, 1), (2, 2), (3, None), (4, None)]


def test_enrich(spark):
    events = spark.createDataFrame([("1", '{"facilityId":"F"}', "own"), ("2", '{"facility_id":"?"}', "own"), ("3", None, "own")], "event_id string, payload string, facility_name string")
    dim = spark.createDataFrame([("F", "old", False), ("F", "new", True)], "facility_id string, facility_name string, is_current boolean")
    got = {r.event_id: r._facility and r._facility.asDict() for r in enrich.enrich(events, facility=dim, carrier=None).collect()}
    assert got["1"] == {"name": "new", "type": None, "region_id": None, "timezone": None}
    assert not any((got[k] or {}).values() for k in ("2", "3")) and enrich.enrich(events).columns == events.columns


def test_session_gap_is_strict(spark):
    df = spark.createDataFrame([("k", NOW), ("k", NOW + dt.timedelta(seconds=300)), ("k", NOW + dt.timedelta(seconds=599))], "k string, event_time timestamp")
    assert sorted(r.n for r in windows.session(df, ["k"]).collect()) == [1, 2]
    assert windows.sliding(df, ["k"]).agg(F.sum("n")).first()[0] == 15


def delivery(spark, rows):
    return spark.createDataFrame([(e, f"delivery.{k}", d, "F", at, json.dumps(p | ({"delivery_id": d} if d else {}))) for e, k, d, at, p in rows], "event_id string, event_type string, delivery_id string, facility_id string, event_time timestamp, payload string")


def test_fact_deliveries(spark):
    h = lambda n: NOW + dt.timedelta(hours=n)
    rows = [
        ("1", "scheduled", "D", h(0), {"carrier_id": "C0"}), ("2", "scheduled", "D", h(1), {"carrier_id": "C1", "scheduled_date": "2025-01-01T15:00:00Z"}), ("3", "attempted", "D", h(2), {}), ("4", "attempted", "D", h(1), {}),
        ("5", "completed", "D", h(3), {"completed_at": "2025-01-01T15:30:30Z", "attempt_count": "2", "was_on_time": True}), ("6", "completed", "E", h(3), {"completed_at": "nonsense", "attempt_count": "x"}),
        ("7", "scheduled", "G", h(3), {}), ("8", "completed", None, h(3), {"completed_at": "2025-01-01T15:30:30Z"}), ("9", "attempted", None, h(1), {}), ("0", "scheduled", None, h(1), {"carrier_id": "X"}),
    ]
    df = delivery(spark, rows)
    got = {r.delivery_id: r for r in marts.fact_deliveries(df).collect()}
    assert set(got) == {"D", "E", None}
    d = got["D"]
    assert (d.carrier_id, d.first_attempt_time, d.attempt_count, d.on_time_flag, d.delivery_duration_minutes) == ("C1", h(1), 2, True, 150)
    assert got["E"].delivery_time is None and got["E"].attempt_count is None and got[None].carrier_id is None and got[None].delivery_duration_minutes == 0
    assert marts.fact_deliveries(df, "2025-01-02").count() == 0 and marts.fact_deliveries(df, "2025-01-01", by_delivery_date=True).count() == 2
    plan = marts.fact_deliveries(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def dims(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, effective_from timestamp, effective_to timestamp, is_current boolean")


def test_merge_history_modes(spark):
    dim = dims(spark, [("a", "A", NOW, None, True), ("b", None, NOW, None, True), ("c", "old", NOW, NOW, False), ("d", "D", NOW, None, True)])
    late = NOW + dt.timedelta(days=1)
    seen = spark.createDataFrame([("a", "A2", late), ("b", "B", late), ("c", "C", late), ("d", "D", late)], "id string, name string, last_updated timestamp")
    rows = lambda df: sorted((r.id, r.name or "", r.is_current, r.effective_to is not None) for r in df.collect())
    plain = marts.merge_history(dim, seen, "id", ["name"])
    assert rows(plain) == [("a", "A", False, True), ("b", "", True, False), ("c", "C", True, False), ("c", "old", False, True), ("d", "D", True, False)]
    full = marts.merge_history(dim, seen, "id", ["name"], full=True)
    assert rows(full) == [("a", "A", False, True), ("a", "A2", True, False), ("b", "", False, True), ("b", "B", True, False), ("c", "C", True, False), ("c", "old", False, True), ("d", "D", True, False)]
    assert marts.merge_history(dim, seen.limit(0), "id", ["name"], full=True).count() == 4
    assert marts.merge_history(dim.limit(0), seen, "id", ["name"]).count() == 4


def test_repair_replaces_only_its_days(spark):
    path = scratch_path(spark, "facts")
    day = lambda n: NOW + dt.timedelta(days=n)
    events = delivery(spark, [(str(n), "completed", f"D{n}", day(n), {"completed_at": day(n).isoformat() + "Z"}) for n in range(3)])
    sinks.write_gold(marts.fact_deliveries(events), path, "delivery_date")
    more = events.unionByName(delivery(spark, [("9", "completed", "D9", day(1), {"completed_at": day(1).isoformat() + "Z"})]))
    operations.repair(spark, path, more, spark.createDataFrame([(day(1).date(),)], "event_date date"))
    got = spark.read.parquet(path)
    assert got.count() == 4 and got.where(F.col("delivery_date") == day(1).date()).count() == 2
    assert sinks.delete_rows(spark, path, "delivery_date", "2025-01-02") == 1 and spark.read.parquet(path).count() == 3


def test_service_levels(spark):
    events = spark.createDataFrame([(NOW, NOW)], "event_time timestamp, ingest_time timestamp")
    facts = spark.createDataFrame([], "delivery_date date")
    r = operations.sla_report(events, facts, "2025-01-01 12:20:00").first()
    assert (r.lag_minutes, r.lag_ok, r.days_behind, r.freshness_ok, r.event_count, r.volume_ok, r.dead_letters_ok) == (20, False, 999, False, 1, False, True)
    said = []
    report = operations.sla_report(events, facts, "2025-01-01 12:20:00")
    assert operations.send(operations.alerts(report), lambda s, t: said.append(t), lambda s, t: 1 / 0) == 3 and len(said) == 3


def test_pages_and_parameters(spark):
    rows, n = operations.page(spark.range(45).toDF("id"), ["id"], 3, 20)
    assert n == 45 and [r.id for r in rows.collect()] == list(range(40, 45))
    with pytest.raises(ValueError, match="pages"):
        operations.page(rows, ["id"], 0)
    assert operations.execute(spark, "SELECT :x + 1 AS y", x=2) == [{"y": 3}]
    kinds = [envelope.literal_type(v).simpleString() for v in (True, 1, 1.0, NOW, NOW.date(), None)]
    assert kinds == ["boolean", "bigint", "double", "timestamp", "date", "string"]


def test_json_scalars(spark):
    texts = ['{"a":{"b":1}}', '{"a":"{1}"}', '{"a":null}', '{"a":[1]}', '{"a":true}', "x", None]
    assert column(spark, texts, lambda c: jsontext.scalar(c, "$.a")) == [None, "{1}", None, None, "true", None, None]


def test_config(tmp_path):
    (tmp_path / "base.yaml").write_text("log_level: INFO\nstreaming: {window_duration_seconds: 60, unknown: 1}\nextra: 'a-${NAME:-b}-c'\n")
    (tmp_path / "prod.yaml").write_text("streaming: {dedupe_window_hours: 4}\n")
    c = config.load(tmp_path, "prod", {"NAME": "x"})
    assert (c.streaming.window_duration_seconds, c.streaming.dedupe_window_hours, c.rest["extra"]) == (60, 4, "a-x-c")
    assert config.load(tmp_path / "none").log_level == "INFO"


def test_schemas_and_kafka(spark):
    assert len(types.event_types()) == 21 and types.event_types("facility")[0] == "facility.created"
    assert [f.name for f in types.silver("?")][-1] == "dedupe_key" and types.schema_string("driver").endswith("vehicle_id:STRING")
    o = kafka.options("h:1", ["a", "b"], "g", username="u", password="p")
    assert o["subscribe"] == "a,b" and "jaas" in " ".join(o) and "kafka.security.protocol" not in kafka.options("h", ["a"], "g", "PLAINTEXT")
    records = spark.createDataFrame([(b"k", b'{"a":1}', "t", 0, 5, NOW), (None, b"raw", "t", 1, 6, NOW)], "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    a, b = kafka.to_messages(records).collect()
    assert a.attributes["_kafka_key"] == "k" and b.data == bytearray(b'{"raw_value":"raw"}') and "_kafka_key" not in b.attributes


def test_tagged_union(spark):
    a, b = msgs(spark, {}), msgs(spark, {}, {}, attributes={"x": "y", "_source_topic": "old"})
    got = messages.tagged_union({"a": a.drop("event_id"), "b": b.drop("event_id")})
    assert sorted(r.attributes["_source_topic"] for r in got.collect()) == ["a", "b", "b"]


def test_metrics_buffer():
    sent = []
    m = Metrics(sent.append, buffer=3, request=2)
    for _ in range(3):
        m.increment("n", kind="x")
    with m.timer("t"):
        pass
    m.close()
    assert [len(s) for s in sent] == [2, 1, 1] and sent[2][0]["name"] == "t_ms"
    bad = Metrics(lambda p: 1 / 0)
    bad.record("x", 1)
    bad.flush()
    assert bad.failed == 1


def test_batch_pipeline(spark):
    out = scratch_path(spark, "out")
    good = {"event_id": "1", "event_type": "shipment.created", "event_time": "2025-01-01T00:00:00Z", "payload": {"shipment_id": "S", "facility_id": "F", "signed_by": "Ann Lee"}}
    dim = spark.createDataFrame([("F", "Hub X")], "facility_id string, facility_name string")
    settings = pipeline.Settings(out, dims={"facility": dim})
    pipeline.run_once(msgs(spark, good, good, {"type": "odd"}, {"event_id": "2", "type": "x.y"}), settings, ingest_time=F.lit(NOW))
    silver = spark.read.parquet(f"{out}/silver/shipment_events").collect()
    assert len(silver) == 1 and silver[0].shipment_id == "S"
    payload = json.loads(silver[0].payload)
    assert payload["signed_by"] == "A*****e" and payload["_facility"]["name"] == "H** X"
    assert spark.read.parquet(f"{out}/dead_letters").count() == 1 and spark.read.parquet(f"{out}/events").count() == 2
    assert pipeline.replay(spark.read.parquet(f"{out}/dead_letters")).columns == ["data", "attributes"]
    sinks.bronze_json(spark.read.parquet(f"{out}/events").drop("route", "event_date", "batch_id"), f"{out}/lines")
    assert spark.read.text(f"{out}/lines/domain=shipment").count() == 1
    with pytest.raises(RuntimeError, match="avro"):
        sinks.bronze_avro(spark.read.parquet(f"{out}/events"), f"{out}/avro")


def test_per_batch_dedupe(spark):
    df = spark.createDataFrame([("a", NOW + dt.timedelta(1)), ("a", NOW), ("b", NOW)], "event_id string, ingest_time timestamp")
    assert sorted((r.event_id, r.ingest_time) for r in state.per_batch(df).collect()) == [("a", NOW), ("b", NOW)]


def test_event_models():
    from harborline import event_models

    all_of = event_models.schemas()
    assert set(all_of) == set(types.event_types()) - {"shipment.returned"}
    started = all_of["delivery.started"]
    assert "stop_number" in started["required"] and started["properties"]["stop_number"] == {"type": "integer", "minimum": 1}
    place = started["definitions"]["location"]["properties"]
    assert place["heading"] == {"type": ["number", "null"], "minimum": 0, "exclusiveMaximum": 360} and place["latitude"]["minimum"] == -90


def test_model_of_an_event(spark):
    from harborline import event_models

    good = {"facility_id": "F", "current_units": 5, "max_capacity_units": 9, "utilization_percentage": 55.5, "previous_utilization_percentage": 0, "change_reason": None}
    bad = good | {"current_units": -1, "utilization_percentage": 101, "is_critical": "yes"}
    df = spark.createDataFrame([("1", "facility.capacity_changed", "v1", json.dumps(p)) for p in (good, bad)], "event_id string, event_type string, event_version string, payload string")
    a, b = validate.validated(df, event_models.schemas("facility.capacity_changed", "driver.assigned")).collect()
    assert a.errors == [] and sorted(e.field for e in b.errors) == ["current_units", "is_critical", "utilization_percentage"]


def test_unknown_keywords_and_enums_are_refused(spark):
    for bad in ({"properties": {"a": {"minItems": 1}}}, {"additionalProperties": False}, {"enum": [[1]]}):
        with pytest.raises(ValueError):
            validate.compile_schema(bad, F.col("x"))


def test_masks_of_columns_and_of_payloads_agree(spark):
    import json
    import random

    from harborline.functions import masking

    r = random.Random(4)
    alphabet = "abcXYZ 0189.@-_äß \t+"
    rows = [(n, "".join(r.choice(alphabet) for _ in range(r.randrange(0, 14)))) for n in range(600)]
    df = spark.createDataFrame(rows, "n bigint, v string")
    for name in ("email", "phone", "first_name", "street", "ssn"):
        for key in (None, b"key"):
            both = df.select("v", masking.mask_value(name, F.col("v"), key).alias("column"), masking.mask_payload(F.to_json(F.struct(F.col("v").alias(name))), key).alias("payload")).collect()
            wrong = [(x.v, x.column, json.loads(x.payload)[name]) for x in both if x.column != json.loads(x.payload)[name]]
            assert not wrong, (name, wrong[:3])

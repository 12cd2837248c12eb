import datetime as dt
import json
import random

import pytest

from harborline.operators import schema_drift

L = "record_id bigint, feed_id string, file_no bigint, event_id string, event_type string, event_time timestamp, payload string, kind string, n int"


def landed(spark, files, feed="f"):
    rows = [(100 * no + k, feed, no, f"e{no}-{k}", "t.a", dt.datetime(2025, 1, 1), p if isinstance(p, str) or p is None else json.dumps(p), "clash", 1) for no, ps in files.items() for k, p in enumerate(ps)]
    return spark.createDataFrame(rows, L)


def found(spark, files):
    return sorted(tuple(r)[1:] for r in schema_drift.changes(schema_drift.profiles(landed(spark, files))).collect())


def make(n, f):
    r = random.Random(5)
    return [f(r) for _ in range(n)]


def base(r):
    return {"shipment_id": f"SHP-{r.randrange(10**6):06d}", "count": r.randrange(1, 5), "place": {"lat": round(r.uniform(-60, 60), 5)}, "ok": r.random() < 0.5}


def test_each_kind_of_change(spark):
    def second(r):
        o = base(r)
        return {"shipmentRef": o["shipment_id"], "count": str(o["count"]), "geo": {"lat": o["place"]["lat"]}, "ok": o["ok"], "firmware": f"fw{r.randrange(9)}.{r.randrange(9)}"}

    def third(r):
        o = second(r)
        return {"shipmentRef": {"code": o["shipmentRef"]}, "count": None, "geo": o["geo"], "ok": o["ok"]}

    got = found(spark, {1: make(30, base), 2: make(30, second), 3: make(30, third)})
    assert got == [
        (2, "added", "firmware", ""), (2, "renamed", "place.lat", "geo.lat"), (2, "renamed", "shipment_id", "shipmentRef"), (2, "retyped", "count", ""),
        (3, "removed", "firmware", ""), (3, "retyped", "shipmentRef", ""),
    ]


def test_unlike_content_is_no_rename(spark):
    got = found(spark, {1: make(30, lambda r: {"a": f"AB-{r.randrange(10**5)}", "k": 1}), 2: make(30, lambda r: {"b": round(r.uniform(-20, 20), 1), "k": 1})})
    assert got == [(2, "added", "b", ""), (2, "removed", "a", "")]


def test_word_fields_of_other_values_are_no_rename(spark):
    few = found(spark, {1: make(30, lambda r: {"colour": r.choice(["red", "green", "blue", "grey", "black"]), "k": 1}), 2: make(30, lambda r: {"state": r.choice(["open", "shut", "broken", "sold", "lost"]), "k": 1})})
    assert few == [(2, "added", "state", ""), (2, "removed", "colour", "")]
    word = lambda r, letters: "".join(r.choice(letters) for _ in range(6))
    many = found(spark, {1: make(200, lambda r: {"colour": word(r, "abcdefgh"), "k": 1}), 2: make(200, lambda r: {"state": word(r, "QRSTUVWX"), "k": 1})})
    assert many == [(2, "added", "state", ""), (2, "removed", "colour", "")]
    # the same values, or so few that they say little, under a like name
    assert found(spark, {1: make(30, lambda r: {"fault": r.choice(["jam", "fire"]), "k": 1}), 2: make(30, lambda r: {"event": r.choice(["jam", "fire"]), "k": 1})}) == [(2, "renamed", "fault", "event")]
    assert found(spark, {1: [{"work_state": "open", "k": 1}], 2: [{"workState": "shut", "k": 1}]}) == [(2, "renamed", "work_state", "workState")]


def test_arrays_count_all_their_elements(spark):
    same = ["a", "b", "c", "d"]
    got = found(spark, {1: make(30, lambda r: {"marks": [*same, *range(10, 20)], "k": 1}), 2: make(30, lambda r: {"notes": [*same, *(x / 7 for x in range(-9, 9))], "k": 1})})
    assert got == [(2, "added", "notes", ""), (2, "removed", "marks", "")]
    assert len(schema_drift.tokens([*same, "e", 1])) == len(schema_drift.tokens(same)) + len(schema_drift.tokens("e")) + len(schema_drift.tokens(1))


def test_neighbours_decide(spark):
    # the container of an enumeration is renamed, and each file holds another value of it
    def held(box, state):
        return lambda r: {box: {"code": f"AB-{r.randrange(10**5):05d}", "weight": round(r.uniform(1, 90), 2), "state": state}, "k": 1}

    assert found(spark, {1: make(30, held("box", "open")), 2: make(30, held("parcel", "shut"))}) == [(2, "renamed", f"box.{x}", f"parcel.{x}") for x in ("code", "state", "weight")]
    # without like neighbours it is another field
    alone = found(spark, {1: make(30, lambda r: {"box": {"state": "open"}, "k": 1}), 2: make(30, lambda r: {"parcel": {"state": "shut"}, "k": 1})})
    assert [x[1] for x in alone] == ["added", "removed"]


def test_unreadable_nulls_and_gaps(spark):
    cut = ['{"shipment_id": "SHP', None, "", "[1]", "3"]
    assert found(spark, {1: make(20, base) + cut, 2: cut + make(20, base), 4: make(20, lambda r: {"x": 1})}) == []
    assert schema_drift.changes(schema_drift.profiles(landed(spark, {}))).count() == 0


def test_one_table_of_renamed_fields(spark):
    def renamed(r):
        o = base(r)
        return {"shipmentId": o["shipment_id"], "count": o["count"], "place": o["place"], "ok": o["ok"]}

    def again(r):
        o = renamed(r)
        return {"shipment_ref": o.pop("shipmentId"), **o}

    data = landed(spark, {1: make(25, base) + ["{cut"], 2: make(25, renamed), 3: make(25, again)})
    out = schema_drift.unified(data.unionByName(data.where("file_no = 2")), "t.a")
    assert set(out.columns) == {"record_id", "feed_id", "file_no", "event_id", "event_time", "readable", "shipment_id", "count", "place__lat", "ok"}
    assert out.count() == 76 and out.where("shipment_id IS NULL").count() == 1 == out.where("NOT readable").count()
    assert dict(out.dtypes)["count"] == "double" and dict(out.dtypes)["ok"] == "boolean"
    assert schema_drift.unified(data.limit(0), "t.a").count() == 0


def test_flooding_converges():
    a = schema_drift.Schema([("p", "string", "", 9), ("q", "object", "", 9), ("q.r", "number", "", 9), ("q.r", "number", "i1", 9)], set())
    content, score = schema_drift.flood(a, a)
    assert (score.argmax(1) == range(3)).all()


@pytest.mark.parametrize("bad", ['{"a": NaN}', '{"a": -Infinity}', '{"a": ' + "[" * 5000 + "]" * 5000 + "}", '{"a": ' + '{"b": ' * 3000 + "1" + "}" * 3000 + "}", '{"a": 1', "[1]", "", "9" * 5000])
def test_unreadable_is_not_fatal(bad):
    assert schema_drift.readable(bad) is None


def test_odd_numbers_and_texts_are_read():
    o = schema_drift.readable('{"a": 1e999, "b": -1e999, "c": 0.0, "d": "\\ud800", "e": [[1, [2]], "x"], "f": ' + "7" * 400 + "}")
    assert all(schema_drift.tokens(v) for v in o.values())
    assert schema_drift.readable("{" + '"k": "[[[[{{{{' + "[" * 500 + '"}') is not None


def test_scores_decide(spark, monkeypatch):
    landed = spark.read.parquet("/root/testdata/sf0.001/landed_records.parquet")
    rows = lambda: sorted(map(tuple, schema_drift.changes(schema_drift.profiles(landed)).collect()))
    right = rows()
    flood = schema_drift.flood
    monkeypatch.setattr(schema_drift, "flood", lambda a, b: (flood(a, b)[0], flood(a, b)[1] * 0))
    assert any(r[2] == "renamed" for r in right) and rows() != right

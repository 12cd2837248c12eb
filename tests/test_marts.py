"""As-of joins over slices, the daily build, serving, attempts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from harborline.operators import slices
from harborline.plans import marts, operations
from harborline.session import scratch_root

EVENTS = "event_id bigint, k string, event_time timestamp, name string"
DIM = "k string, label string, effective_from timestamp, effective_to timestamp"


def at(h):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)


def versions(spark):
    rows = [("hot", f"v{n}", at(10 * n), at(10 * n + 10) if n < 40 else None) for n in range(1, 41)] + [("gap", "a", at(0), at(5)), ("gap", "b", at(8), None), (None, "x", at(0), None)]
    return spark.createDataFrame(rows, DIM)


def events(spark):
    rows = [(n, "hot", at(n % 450), "e") for n in range(900)] + [(2000 + n, "gap", at(n), "e") for n in range(10)] + [(3000, None, at(1), "e"), (3001, "hot", None, "e"), (3002, "none", at(1), "e")]
    return spark.createDataFrame(rows, EVENTS)


def test_asof_over_slices_is_as_broadcast(spark, monkeypatch):
    # one key holds nine tenths of the rows
    few = lambda df: sorted((r.event_id, r.label) for r in df.select("event_id", F.coalesce("label", F.lit("")).alias("label")).collect())
    whole = few(marts.asof(events(spark), versions(spark), "k"))
    monkeypatch.setattr(marts, "sliced", lambda df, k, o, n: slices.sliced(df, k, o, n, slice_bytes=500))
    out = marts.asof(events(spark), versions(spark), "k", limit=0)
    assert few(out) == whole and len(whole) == 913
    assert dict(whole)[0] == "" and dict(whole)[10] == "v1" and dict(whole)[449] == "v40" and dict(whole)[2006] == "" and dict(whole)[2008] == "b" and dict(whole)[3000] == ""
    assert marts.asof(events(spark).limit(0), versions(spark), "k", limit=0).count() == 0
    assert marts.asof(events(spark), versions(spark).limit(0), "k", limit=0).where("label IS NOT NULL").count() == 0


def test_build_refuses_days_without_sources(spark, tmp_path):
    empty = spark.createDataFrame([], "event_id string, event_type string, event_time timestamp, payload string, shipment_id string, facility_id string, carrier_id string, delivery_id string")
    with pytest.raises(RuntimeError, match="sources"):
        marts.build_day(spark, str(tmp_path), empty, "2024-01-01")


def test_retries():
    calls = []

    def task():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "done"

    assert operations.retried(task, 2, sleep=lambda s: None) == "done"
    with pytest.raises(ZeroDivisionError):
        operations.retried(lambda: 1 / 0, 1, sleep=lambda s: None)


def test_serving_limits(spark):
    facts = spark.createDataFrame([], "shipment_id string, event_id string, event_type string, event_time timestamp, facility_id string, status string, latitude double, longitude double")
    for limit in (0, 1001):
        with pytest.raises(ValueError):
            operations.shipment_events(facts, "s", limit)
    gold = spark.createDataFrame([], "facility_id string, delivery_date date, on_time_flag boolean, delivery_duration_minutes bigint, attempt_count bigint")
    assert operations.facility_day(gold, "F", "2024-01-02 00:00:00") is None
    assert operations.table_name("p", "d", "t`x") == "`p`.`d`.`t``x`"


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, *a):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})  # noqa: N815

    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch_root(Cluster())


def test_spread(spark, sf, tmp_path):
    from harborline.session import spread, table

    df = table(spark, sf, "documents")
    wide = spread(df.select("doc_id"))
    assert wide.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and wide.count() == df.count()
    grouped = df.groupBy("lang").count()
    assert spread(grouped) is grouped and spread(wide) is wide
    stream = spark.readStream.schema("a int").parquet(str(tmp_path))
    assert spread(stream) is stream

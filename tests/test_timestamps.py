import datetime as dt
import json
from zoneinfo import ZoneInfo

import pytest

from harborline.operators import timestamps

UTC = dt.timezone.utc


def us(*a, tz=UTC, fold=0):
    d = dt.datetime(*a, tzinfo=ZoneInfo(tz) if isinstance(tz, str) else tz, fold=fold).astimezone(UTC)
    return (d - dt.datetime(1970, 1, 1, tzinfo=UTC)) // dt.timedelta(microseconds=1)


def normalised(spark, texts, zone=None, source="s"):
    messages = spark.createDataFrame([(n, t, source, "F" if zone else None, None) for n, t in enumerate(texts)], "message_id bigint, event_time string, source_system string, facility_id string, payload string")
    facilities = spark.createDataFrame([("F", zone), ("F", zone)], "facility_id string, timezone string")
    return {r.message_id: r.utc_us for r in timestamps.normalise(messages, facilities).orderBy("message_id").collect()}


CASES = [
    ("2025-06-01T01:01:22.410692Z", us(2025, 6, 1, 1, 1, 22, 410692)), ("2024-10-30T00:22:57.270997910Z", us(2024, 10, 30, 0, 22, 57, 270997)), ("2025-10-09t06:47:38z", us(2025, 10, 9, 6, 47, 38)),
    ("2025-09-24T17:05:46-07", us(2025, 9, 25, 0, 5, 46)), ('"2025-02-26T01:02:03+05:30"', us(2025, 2, 25, 19, 32, 3)), ("20241124T123256Z", us(2024, 11, 24, 12, 32, 56)),
    ("2024-261T03:02:19Z", us(2024, 9, 17, 3, 2, 19)), ("Tue, 11 Nov 2025 04:59:21 -0500", us(2025, 11, 11, 9, 59, 21)), ("24 Aug 2025 10:51:21 UT", us(2025, 8, 24, 10, 51, 21)),
    ("Oct 28, 2024 07:27 pm", us(2024, 10, 28, 19, 27)), ("Mar 5, 2025 12:04 am", us(2025, 3, 5, 0, 4)), ("22:55:40 2025-11-16 CST", us(2025, 11, 17, 4, 55, 40)), ("2025-08-03 19:18:59 EDT", us(2025, 8, 3, 23, 18, 59)),
    ("2025-02-06 01:39:39 -0500", us(2025, 2, 6, 6, 39, 39)), ("2024-11-02 11:57:47-0400", us(2024, 11, 2, 15, 57, 47)), ("2025-10-19 02:29:59,631", us(2025, 10, 19, 2, 29, 59, 631000)), ("20240929032302", us(2024, 9, 29, 3, 23, 2)),
    ("2025-03-14T24:00:00", us(2025, 3, 15)), ("2025-04-15T08:22", us(2025, 4, 15, 8, 22)), ("2024-11-03T01:10:33-04:00[America/New_York]", us(2024, 11, 3, 5, 10, 33)), ("2025-01-02T23:46:55[UTC]", us(2025, 1, 2, 23, 46, 55)),
    ("\t1743173511  ", 1743173511_000000), ("1732098441278", 1732098441278_000), ("1746049061670306", 1746049061670306), ("1741998444.882", 1741998444_882000),
    ("", None), ("  ", None), ("N/A", None), ("pending", None), ("-", None), ("null", None), ("25:61", None), ("2025-02-30T10:15:00Z", None), ("0000-00-00T00:00:00Z", None), ("2025-13-04 08:00:00", None), ("2025-01-01 10:00:00 XYZ", None),
    ("2025-366T00:00:00Z", None), ("12345", None), ("x" * 100_000, None), ("2025-01-01T24:00:01", None), ("2025-01-01T10:00:00+25:00", None),
]


def test_formats(spark):
    out = normalised(spark, [t for t, _ in CASES])
    assert {t[:40]: out[n] for n, (t, _) in enumerate(CASES)} == {t[:40]: v for t, v in CASES}


@pytest.mark.parametrize("zone", ["America/New_York", "america/new york ", "US/Eastern"])
def test_repeated_and_skipped_hours(spark, zone):
    out = normalised(spark, ["2024-11-03 01:30:00", "2025-03-09 02:30:00", "2025-07-01 12:00:00", "2025-07-01 12:00:00Z"], zone)
    assert list(out.values()) == [us(2024, 11, 3, 5, 30), us(2025, 3, 9, 7, 30), us(2025, 7, 1, 16), us(2025, 7, 1, 12)]


def test_unknown_zone_counts_as_missing(spark):
    assert normalised(spark, ["2025-07-01 12:00:00"], "Mars/Base")[0] == us(2025, 7, 1, 12)


def test_order_of_day_and_month_by_source(spark):
    assert list(normalised(spark, ["03/04/2025 10:00", "25/04/2025 10:00"]).values()) == [us(2025, 4, 3, 10), us(2025, 4, 25, 10)]
    assert list(normalised(spark, ["03/04/2025 10:00", "04/25/2025 10:00:05 PM"]).values()) == [us(2025, 3, 4, 10), us(2025, 4, 25, 22, 0, 5)]
    assert normalised(spark, ["03.04.2025 10:00:00", "14.03.2025 14:45:56"])[0] == us(2025, 4, 3, 10)


def test_payload_numbers_nulls_and_empty(spark):
    payloads = [json.dumps({"timestamp": 1761902945.95}), json.dumps({"timestamp": None}), "{broken", None, json.dumps({"timestamp": 1748416222963}), "[]", json.dumps({"other": 1})]
    messages = spark.createDataFrame([(n, None, None, None, p, "x") for n, p in enumerate(payloads)], "message_id bigint, event_time string, source_system string, facility_id string, payload string, utc_us string")
    facilities = spark.createDataFrame([], "facility_id string, timezone string")
    out = {(r.message_id, r.field_name): r.utc_us for r in timestamps.normalise(messages, facilities).collect()}
    assert out == {(0, "timestamp"): 1761902945_950000, (4, "timestamp"): 1748416222963_000}
    assert timestamps.normalise(messages.limit(0), facilities).count() == 0


def test_separators_alone_state_nothing(spark):
    assert set(normalised(spark, ["2024|1|2|3|4|5|||Z|", "||||||||||", "a|b"]).values()) == {None}

import datetime as dt
import math

import numpy as np
import pytest

from harborline.operators import history, slices, trips

U = "update_id bigint, event_id string, facility_id string, updated_fields array<string>, facility_name string, status string, capacity_units bigint, event_time timestamp, ingest_time timestamp, entity string"
FAC = "facility_id string, facility_name string, status string, capacity_units bigint, event_time timestamp"


def at(h):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)


def versions(spark, updates, facilities=(("F", "A", "on", 1, 0),)):
    u = spark.createDataFrame([(n, e, "F", fields, name, status, cap, at(t), at(i), "clash") for n, (e, fields, name, status, cap, t, i) in enumerate(updates)], U)
    f = spark.createDataFrame([(*x[:4], at(x[4])) for x in facilities], FAC)
    return [(r.facility_name, r.status, r.capacity_units, r.valid_from, r.valid_to) for r in history.facility_history(f, u).orderBy("valid_from").collect()]


def test_changes_late_and_without_effect(spark):
    got = versions(spark, [("a", ["facilityName"], "B", "ignored", None, 5, 5), ("b", ["status"], None, "on", None, 6, 6), ("c", None, None, "off", None, 3, 99), ("d", ["capacity_units"], None, None, None, 8, 8), ("e", [], "Z", "z", 9, 9, 9)])
    assert got == [("A", "on", 1, at(0), at(3)), ("A", "off", 1, at(3), at(5)), ("B", "off", 1, at(5), at(6)), ("B", "on", 1, at(6), at(8)), ("B", "on", None, at(8), None)]


def test_ties_and_copies(spark):
    # equal times apply by ingest_time and give one version; copies count at their earliest arrival
    got = versions(spark, [("a", ["facility_name"], "X", None, None, 4, 7), ("b", ["facility_name"], "Y", None, None, 4, 6), ("c", ["facility_name"], "Y", None, None, 5, 5), ("C", ["facility_name"], "Q", None, None, 5, 9)])
    assert [g[0] for g in got] == ["A", "X", "Y"]


def test_empty_and_unplaced(spark):
    assert versions(spark, [], ()) == []
    assert versions(spark, [("a", ["status"], None, "x", None, 1, 1)], ()) == []  # no row in facilities, no history
    assert len(versions(spark, [("a", ["status"], None, "x", None, -5, 1)])) == 1  # before the creation


def test_hot_entity_over_many_slices(spark, monkeypatch):
    monkeypatch.setattr(history, "sliced", lambda df, k, o, n: slices.sliced(df, k, o, n, slice_bytes=500))
    got = versions(spark, [(f"e{n}", ["capacity_units"], None, None, n // 3, n + 1, n) for n in range(300)])
    assert [g[2] for g in got] == [1, *range(100)] and all(a[4] == b[3] for a, b in zip(got, got[1:]))


# ---- trips

P = "ping_id bigint, driver_id string, location struct<latitude: double, longitude: double>, event_timestamp timestamp, session string, block int"


def track(legs, seed=0):
    """(seconds, metres east) of legs: ('stop', seconds, step) or ('go', metres, speed, step) or ('gap', seconds)."""
    rng, t, x, out = np.random.default_rng(seed), 0.0, 0.0, []
    for leg in legs:
        if leg[0] == "stop":
            for _ in range(int(leg[1] // leg[2]) + 1):
                out.append((t, x + rng.normal(0, 6), rng.normal(0, 6)))
                t += leg[2]
        elif leg[0] == "go":
            n = int(leg[1] / leg[2] / leg[3])
            for _ in range(n):
                t, x = t + leg[3], x + leg[2] * leg[3]
                out.append((t, x + rng.normal(0, 6), rng.normal(0, 6)))
            t, x = t + leg[3], x + leg[2] * leg[3]
        else:
            t += leg[1]
    return out


def segments(spark, points, extra=()):
    rows = [(n, "D", {"latitude": 50 + y / trips.METRES, "longitude": 8 + x / (trips.METRES * math.cos(math.radians(50)))}, dt.datetime(2025, 1, 1) + dt.timedelta(seconds=t), "c", 0) for n, (t, x, y) in enumerate(points)]
    df = spark.createDataFrame([*rows, *extra], P)
    return [(r.segment_kind, r.first_ping_id, r.last_ping_id) for r in trips.segments(df).orderBy("started", "ended").collect()]


def test_stop_trip_stop(spark):
    points = track([("stop", 900, 40), ("go", 5000, 9, 30), ("stop", 1200, 40)])
    n = 23
    out = segments(spark, points)
    assert [k for k, *_ in out] == ["stop", "trip", "stop"] and out[0][1:] == (0, n - 1) and out[1][1] == n - 1 and out[2][2] == len(points) - 1 and out[1][2] == out[2][1]


def test_pause_is_no_stop_and_sparse_stop_is(spark):
    out = segments(spark, track([("stop", 600, 40), ("go", 3000, 9, 30), ("stop", 150, 30), ("go", 3000, 9, 30), ("stop", 420, 105)]))
    assert [k for k, *_ in out] == ["stop", "trip", "stop"]


def test_strays_and_repeats(spark):
    points = track([("stop", 900, 40), ("go", 4000, 9, 30), ("stop", 900, 40)])
    clean = segments(spark, points)
    points[5] = (points[5][0], points[5][1] + 3000, 4000)
    repeat = (999, "D", {"latitude": 0.0, "longitude": 0.0}, dt.datetime(2025, 1, 1), "c", 0)
    assert segments(spark, points, [repeat]) == clean


def test_silence_ends_stop_and_trip(spark):
    out = segments(spark, track([("stop", 600, 40), ("gap", 8000), ("stop", 600, 40), ("gap", 3000), ("stop", 600, 40)]))
    assert [k for k, *_ in out] == ["stop", "stop"]
    out = segments(spark, track([("stop", 600, 40), ("go", 3000, 9, 30), ("gap", 8000), ("go", 3000, 9, 30), ("stop", 600, 40)]))
    assert [k for k, *_ in out] == ["stop", "stop"]


def test_nulls_and_empty(spark):
    none = [(1, None, None, None, None, None), (2, "D", None, dt.datetime(2025, 1, 1), None, 1), (3, "D", {"latitude": None, "longitude": 1.0}, dt.datetime(2025, 1, 1), None, 1), (4, "D", {"latitude": 999.0, "longitude": 1.0}, dt.datetime(2025, 1, 1), None, 1)]
    assert segments(spark, [], none) == [] and segments(spark, []) == []


def test_blocks_of_a_device_that_is_never_silent(spark, monkeypatch):
    points = track([leg for _ in range(6) for leg in (("stop", 3000, 60), ("go", 6000, 9, 30))] + [("stop", 3000, 60)])
    whole = segments(spark, points)
    monkeypatch.setattr(trips, "BLOCK_S", 5_000)
    monkeypatch.setattr(trips, "MARGIN_S", 4_000)
    assert segments(spark, points) == whole and len(whole) == 13


def test_distances_over_blocks(spark, monkeypatch):
    # stops and trips over two and more blocks, one of which no block sees in whole: each has the path between its pings
    points = track([("stop", 3000, 60), ("go", 6000, 9, 30), ("stop", 6000, 60), ("go", 60_000, 9, 30), ("stop", 3000, 60)])
    rows = [(n, "D", {"latitude": 50 + y / trips.METRES, "longitude": 8 + x / (trips.METRES * math.cos(math.radians(50)))}, dt.datetime(2025, 1, 1) + dt.timedelta(seconds=t), "c", 0) for n, (t, x, y) in enumerate(points)]
    path = np.concatenate([[0], np.cumsum(np.hypot(*np.diff(np.array(points)[:, 1:], axis=0).T))])
    for block in (trips.BLOCK_S, 5_000, 1_500):
        monkeypatch.setattr(trips, "BLOCK_S", block)
        monkeypatch.setattr(trips, "MARGIN_S", min(block, 4_000))
        got = trips.segments(spark.createDataFrame(rows, P)).orderBy("started", "ended").collect()
        assert [r.segment_kind for r in got] == ["stop", "trip", "stop", "trip", "stop"]
        for r in got:
            assert r.distance_m == pytest.approx(path[r.last_ping_id] - path[r.first_ping_id], rel=1e-3)


@pytest.mark.parametrize("seed", range(3))
def test_long_durations(seed):
    points = np.array(track([("stop", 400_000, 40), ("go", 200_000, 9, 30), ("stop", 6000, 40)], seed))
    assert len(trips.stops_of(points[:, 0], points[:, 1:])) == 2


def test_decoding_decides(spark, sf, monkeypatch):
    points = np.array(track([("stop", 900, 40), ("go", 4000, 9, 30), ("stop", 900, 40), ("go", 4000, 9, 30), ("stop", 900, 40)]))
    assert len(trips.stops_of(points[:, 0], points[:, 1:])) == 3
    monkeypatch.setattr(trips, "decode", lambda t, p: [(0, len(t) - 1)])
    assert len(trips.stops_of(points[:, 0], points[:, 1:])) < 3


def _best_by_enumeration(t, p):
    """Score and stops of the best segmentation, with every pair of pings as a stop; the model written out once more."""
    d, dt = np.maximum(np.hypot(*np.diff(p, axis=0).T), 1.0), np.diff(t)
    logn = lambda x, m, s: -0.5 * (math.log(x / m) / s) ** 2 - math.log(x * s * math.sqrt(2 * math.pi))
    step = [np.logaddexp(math.log(1 - trips.PAUSES) + logn(a / b, trips.SPEED, trips.SPEED_SD) - math.log(b) - math.log(2 * math.pi * a), math.log(trips.PAUSES) - math.log(4 * math.pi * trips.NOISE_M**2) - a * a / (4 * trips.NOISE_M**2) - b / trips.PAUSE_S) for a, b in zip(d, dt)]
    trip = lambda i, j: sum(step[i:j]) + logn(t[j] - t[i], trips.TRIP_S, trips.TRIP_SD) if j > i else 0.0

    def stop(i, j):
        q, v = p[i : j + 1], trips.NOISE_M**2
        return -(j - i) * math.log(2 * math.pi * v) - math.log(j - i + 1) - ((q - q.mean(0)) ** 2).sum() / (2 * v) + logn(t[j] - t[i], trips.STOP_S, trips.STOP_SD)

    n = len(t)
    best = {}  # last ping of the last stop -> (score, stops)
    for j in range(n):
        for i in range(j):
            if t[j] - t[i] < trips.LEAST_S:
                continue
            before = max([(trip(0, i), [])] + [(s + trip(e, i), x) for e, (s, x) in best.items() if e < i], key=lambda x: x[0])
            score = before[0] + stop(i, j)
            if j not in best or score > best[j][0]:
                best[j] = (score, before[1] + [(i, j)])
    ends = [(trip(0, n - 1), [])] + [(s + (trip(e, n - 1) if e < n - 1 else 0), x) for e, (s, x) in best.items()]
    return max(ends, key=lambda x: x[0])[1]


@pytest.mark.parametrize("seed", range(6))
def test_viterbi_is_exact(seed):
    rng = np.random.default_rng(seed)
    legs = [leg for _ in range(3) for leg in (("stop", int(rng.integers(310, 900)), 50), ("go", int(rng.integers(600, 2500)), 9, 40))]
    points = np.array(track(legs, seed))
    assert trips.decode(points[:, 0], points[:, 1:]) == _best_by_enumeration(points[:, 0], points[:, 1:])


def by_definition(t, p):
    """(first, last) of stops by growing each from its first ping: within the radius of the median so far, one ping elsewhere disregarded."""
    out, i = [], 0
    while i < len(t):
        members, missed = [i], 0
        for j in range(i + 1, len(t)):
            centre = np.median(p[members], axis=0)
            if t[j] - t[j - 1] > trips.SILENCE_S:
                break
            if np.hypot(*(p[j] - centre)) <= trips.RADIUS_M:
                members.append(j)
                missed = 0
            else:
                missed += 1
                if missed > 1:
                    break
        centre = np.median(p[members], axis=0)
        members = [k for k in members if np.hypot(*(p[k] - centre)) <= trips.RADIUS_M]
        if members and t[members[-1]] - t[members[0]] >= trips.LEAST_S:
            out.append((members[0], members[-1]))
            i = members[-1] + 1
        else:
            i += 1
    return out


def test_stops_as_by_definition(spark):
    pings = spark.read.parquet("/root/testdata/sf0.01/driver_locations.parquet")
    ours = {(r.driver_id, r.first_ping_id, r.last_ping_id) for r in trips.stops(pings).collect()}
    rows = pings.selectExpr("driver_id", "ping_id", "unix_micros(event_timestamp) / 1e6 AS t", "location.latitude AS lat", "location.longitude AS lon").toPandas().dropna().sort_values(["driver_id", "t", "ping_id"])
    rows = rows.drop_duplicates(["driver_id", "t"])
    theirs = set()
    for driver, x in rows.groupby("driver_id"):
        t, ids = x.t.to_numpy(), x.ping_id.to_numpy()
        east = np.cos(np.radians(x.lat.median())) * trips.METRES * (x.lon - x.lon.median())
        theirs |= {(driver, ids[a], ids[b]) for a, b in by_definition(t, np.column_stack([east, trips.METRES * (x.lat - x.lat.median())]))}
    assert len(theirs) > 100
    assert len(ours & theirs) >= 0.99 * max(len(ours), len(theirs))

"""Stops and trips from location pings by hidden semi-Markov decoding.

Pings are cut at long silences into sessions and, should a device never be silent, into blocks of some days that overlap.
A block is decoded by a two-state hidden semi-Markov model with explicit stop and travel durations, which sets the number
and the borders of stops; the ends of a decoded stop are then trimmed to the pings within a radius of its centre.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.operators.slices import sliced

RADIUS_M, LEAST_S, SILENCE_S = 100.0, 300.0, 7200.0
#: Length of a block and of the context on either side of it that is decoded with it.
BLOCK_S, MARGIN_S = 7 * 86_400, 86_400
#: Emissions: noise of a standing device on each axis (m), log-normal speed of travel (m/s), share of pauses in travel and their mean length (s).
NOISE_M, SPEED, SPEED_SD, PAUSES, PAUSE_S = 12.0, 8.0, 0.9, 0.1, 20.0
#: Log-normal durations (s): medians and deviations of stops (cut at LEAST_S) and of trips.
STOP_S, STOP_SD, TRIP_S, TRIP_SD = 1500.0, 1.1, 900.0, 1.2
METRES = 111_195.0


def _log_normal(x, median, sd):
    x = np.maximum(x, 1e-9)
    return -0.5 * (np.log(x / median) / sd) ** 2 - np.log(x * sd * np.sqrt(2 * np.pi))


def metres(lat, lon):
    """Plane coordinates around the median position, in metres; longitudes are unwrapped at the date line."""
    lon0, lat0 = np.median(lon), np.median(lat)
    east = (lon - lon0 + 180.0) % 360.0 - 180.0
    return np.column_stack([east * METRES * np.cos(np.radians(lat0)), (lat - lat0) * METRES])


def steps(lat, lon):
    """Length of each step in metres, at the step's own latitude: the same in whatever block it is measured."""
    east = (np.diff(lon) + 180.0) % 360.0 - 180.0
    return METRES * np.hypot(east * np.cos(np.radians((lat[1:] + lat[:-1]) / 2)), np.diff(lat))


def gate(t, p) -> np.ndarray:
    """Which pings aren't strays: a stray is a detour that neither its forerunner nor its follower is near to."""
    n, t, x, y = len(t), t.tolist(), p[:, 0].tolist(), p[:, 1].tolist()
    keep = np.ones(n, bool)
    far = lambda a, b: math.hypot(x[a] - x[b], y[a] - y[b])
    jump = lambda a, b: far(a, b) > 300 and far(a, b) > 70 * abs(t[b] - t[a])
    last = -1
    for k in range(n):
        if last < 0:
            if k + 2 < n and jump(k, k + 1) and not jump(k + 1, k + 2):
                keep[k] = False
                continue
        elif k + 1 < n:
            out = far(last, k)
            if out > RADIUS_M:
                back, direct = far(k, k + 1), far(last, k + 1)
                if (back > RADIUS_M and direct < RADIUS_M) or (out + back - direct > 600 and out > 300 and back > 300):
                    keep[k] = False
                    continue
        elif jump(last, k):
            keep[k] = False
            continue
        last = k
    return keep


def _first_near(p, j: int) -> int:
    """First ping of the run up to j in which all pings could share a place with j."""
    hi, size = j, 64
    while hi > 0:
        lo = max(0, hi - size)
        away = np.flatnonzero(np.hypot(*(p[lo:hi] - p[j]).T) > 2 * RADIUS_M)
        if len(away):
            return lo + int(away[-1]) + 1
        hi, size = lo, size * 2
    return 0


def decode(t, p) -> list[tuple[int, int]]:
    """Most likely stops as (first, last) positions in pings sorted by time, by exact explicit-duration Viterbi.

    A stop emits positions around an unknown centre, a trip emits steps; both have explicit durations, however long. The
    state changes only next to a step that is more likely of travel than of standing, so only such pings are compared.
    """
    n = len(t)
    if n < 2 or t[-1] - t[0] < LEAST_S:
        return []
    d, dt = np.maximum(np.hypot(*np.diff(p, axis=0).T), 1.0), np.maximum(np.diff(t), 0.5)
    flat = np.log(2 * np.pi * d)  # a length as a density over the plane
    going = _log_normal(d / dt, SPEED, SPEED_SD) - np.log(dt) - flat
    still = lambda s: -np.log(2 * np.pi * s * s) - d * d / (2 * s * s)
    pausing = still(NOISE_M * np.sqrt(2)) - dt / PAUSE_S
    moving = np.concatenate([[0], np.cumsum(np.logaddexp(np.log(1 - PAUSES) + going, np.log(PAUSES) + pausing))])
    border = going > still(NOISE_M * np.sqrt(2))
    begins = np.flatnonzero(np.concatenate([[True], border]))
    ends = np.flatnonzero(np.concatenate([border, [True]]))
    s1, s2 = np.vstack([np.zeros(2), np.cumsum(p, axis=0)]), np.concatenate([[0], np.cumsum((p * p).sum(1))])
    entry = np.full(n, -np.inf)  # best score of all before a stop that begins at the ping
    came = np.full(n, -1)  # last ping of the stop before it
    left: list[int] = []  # ends of stops so far, with their scores and first pings
    score: list[float] = []
    first: list[int] = []

    def trip(j: int) -> tuple[float, int]:
        """Best score of arriving at ping j by a trip, and where it began; -1 for a session that begins with it."""
        best, at = (moving[j] + float(_log_normal(t[j] - t[0], TRIP_S, TRIP_SD)), -1) if j else (0.0, -1)
        before = bisect_left(left, j)
        if before:
            e = np.array(left[:before])
            total = np.array(score[:before]) + moving[j] - moving[e] + _log_normal(t[j] - t[e], TRIP_S, TRIP_SD)
            k = int(np.argmax(total))
            if total[k] > best:
                best, at = float(total[k]), int(e[k])
        return best, at

    for j in ends:
        lo = _first_near(p, j)
        own = begins[np.searchsorted(begins, lo) : np.searchsorted(begins, j)]
        own = own[t[j] - t[own] >= LEAST_S]
        if not len(own):
            continue
        for i in own[entry[own] == -np.inf]:
            entry[i], came[i] = trip(i)
        m = j - own + 1
        total = s1[j + 1] - s1[own]
        spread = s2[j + 1] - s2[own] - (total * total).sum(1) / m
        fit = entry[own] - (m - 1) * np.log(2 * np.pi * NOISE_M**2) - np.log(m) - spread / (2 * NOISE_M**2) + _log_normal(t[j] - t[own], STOP_S, STOP_SD)
        k = int(np.argmax(fit))
        left.append(int(j))
        score.append(float(fit[k]))
        first.append(int(own[k]))
    if not left:
        return []
    begun = dict(zip(left, first))
    best, at = trip(n - 1)
    if left[-1] == n - 1 and score[-1] >= best:
        at = n - 1
    stops = []
    while at >= 0:
        stops.append((begun[at], at))
        at = int(came[begun[at]])
    return stops[::-1]


def trim(t, p, a: int, b: int, lower: int, upper: int) -> tuple[int, int] | None:
    """A decoded stop by the definition: from its first to its last ping within the radius of its centre, with neighbours that are; None if too short."""
    centre = np.median(p[a : b + 1], axis=0)
    inside = np.flatnonzero(np.hypot(*(p[lower : upper + 1] - centre).T) <= RADIUS_M) + lower
    core = inside[(inside >= a) & (inside <= b)]
    if not len(core):
        return None
    first, last = int(core[0]), int(core[-1])
    while first - 1 >= lower and np.hypot(*(p[first - 1] - centre)) <= RADIUS_M:
        first -= 1
    while last + 1 <= upper and np.hypot(*(p[last + 1] - centre)) <= RADIUS_M:
        last += 1
    return (first, last) if t[last] - t[first] >= LEAST_S else None


def stops_of(t, p) -> list[tuple[int, int]]:
    """Stops among gated pings: the decoded ones, trimmed; neighbours at one place with nothing else between them are one."""
    decoded, out = decode(t, p), []
    for k, (a, b) in enumerate(decoded):
        lower = max(decoded[k - 1][1] + 1 if k else 0, out[-1][1] + 1 if out else 0)
        upper = decoded[k + 1][0] - 1 if k + 1 < len(decoded) else len(t) - 1
        held = trim(t, p, max(a, lower), b, lower, upper) if b > lower else None
        if held is None:
            continue
        if out:
            centre = np.median(p[out[-1][0] : held[1] + 1], axis=0)
            if (np.hypot(*(p[out[-1][0] : held[1] + 1] - centre).T) <= RADIUS_M).all():
                out[-1] = (out[-1][0], held[1])
                continue
        out.append(held)
    return out


_PIECE = "driver_id string, session timestamp, block long, first_ping_id long, last_ping_id long, started_us long, ended_us long, latitude double, longitude double, from_m double, to_m double, open_left boolean, open_right boolean, core struct<lat0: double, lon0: double, lat1: double, lon1: double, m: double>"

_COLUMNS = "driver_id session block first_ping_id last_ping_id started_us ended_us latitude longitude from_m to_m open_left open_right core".split()


def _decode_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """A row without pings for the block itself, with the ends and the path of its core, and one per stop in the core.

    What is measured along the path counts from the first ping of the core; the context is for decoding alone.
    """
    driver, session, block = pdf.driver_id.iloc[0], pdf.session.iloc[0], int(pdf.block.iloc[0])
    pdf = pdf.sort_values("us")
    t, lat, lon, ids = pdf.us.to_numpy() / 1e6, pdf.latitude.to_numpy(), pdf.longitude.to_numpy(), pdf.ping_id.to_numpy()
    core = (pdf.own_block == pdf.block).to_numpy()
    keep = gate(t, metres(lat, lon))
    t, lat, lon, ids, core = t[keep], lat[keep], lon[keep], ids[keep], core[keep]
    rows = []
    if core.any():
        p = metres(lat, lon)
        path = np.concatenate([[0], np.cumsum(steps(lat, lon))])
        lo, hi = int(np.argmax(core)), len(core) - 1 - int(np.argmax(core[::-1]))
        path -= path[lo]
        rows.append((driver, session, block, *[None] * 10, {"lat0": lat[lo], "lon0": lon[lo], "lat1": lat[hi], "lon1": lon[hi], "m": path[hi]}))
        for a, b in stops_of(t, p):
            x, y = max(a, lo), min(b, hi)
            if x <= y:
                rows.append((driver, session, block, ids[x], ids[y], int(round(t[x] * 1e6)), int(round(t[y] * 1e6)), float(np.median(lat[x : y + 1])), float(np.median(lon[x : y + 1])), float(path[x]), float(path[y]), bool(a < lo), bool(b > hi), None))
    return pd.DataFrame(rows, columns=_COLUMNS, dtype=object)


def sessions(pings: DataFrame) -> DataFrame:
    """One ping per driver and time (smallest ping_id) with its session, named by the time it starts.

    Rows without driver, ping_id, time or position (or with an impossible one) are left out. Works on slices, so that no driver's pings meet in one task.
    """
    rows = pings.select("driver_id", "ping_id", F.col("event_timestamp").alias("at"), F.col("location.latitude").alias("latitude"), F.col("location.longitude").alias("longitude"))
    rows = rows.where("driver_id IS NOT NULL AND ping_id IS NOT NULL AND at IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180")
    rows = rows.groupBy("driver_id", "at").agg(F.min("ping_id").alias("ping_id"), F.min_by("latitude", "ping_id").alias("latitude"), F.min_by("longitude", "ping_id").alias("longitude"))
    rows = sliced(rows, ["driver_id"], ["at"], "pings")
    ends = rows.groupBy("driver_id", "_slice").agg(F.max("at").alias("_last"))
    before = Window.partitionBy("driver_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("driver_id", "_slice", F.max("_last").over(before).alias("_before"))
    running = Window.partitionBy("driver_id", "_slice").orderBy("at")
    rows = rows.join(ends, ["driver_id", "_slice"]).withColumn("_previous", F.coalesce(F.lag("at").over(running), F.col("_before")))
    starts = F.col("_previous").isNull() | (F.unix_micros("at") - F.unix_micros("_previous") > int(SILENCE_S * 1e6))
    rows = rows.withColumn("_start", F.when(starts, F.col("at"))).withColumn("_mine", F.last("_start", ignorenulls=True).over(running))
    carried = rows.groupBy("driver_id", "_slice").agg(F.max("_start").alias("_s"))
    carried = carried.select("driver_id", "_slice", F.last("_s", ignorenulls=True).over(before).alias("_carried"))
    return rows.join(carried, ["driver_id", "_slice"]).select("driver_id", "ping_id", "at", "latitude", "longitude", F.coalesce("_mine", "_carried").alias("session"))


def stops(pings: DataFrame) -> DataFrame:
    """Every stop: driver_id, session, first and last ping, start, end, centre and the session's path up to its first and last ping.

    An empty table, or one without a usable ping, gives no rows.
    """
    rows = sessions(pings).withColumn("us", F.unix_micros("at"))
    since = F.col("us") - F.unix_micros("session")
    own, into = F.floor(since / (BLOCK_S * 1_000_000)).cast("long"), since % (BLOCK_S * 1_000_000)
    rows = rows.withColumn("own_block", own).withColumn(
        "block",
        F.explode(F.array_compact(F.array(F.col("own_block"), F.when((into < MARGIN_S * 1_000_000) & (own > 0), own - 1), F.when(into >= (BLOCK_S - MARGIN_S) * 1_000_000, own + 1)))),
    )
    pieces = rows.select("driver_id", "session", "block", "own_block", "us", "ping_id", "latitude", "longitude").groupBy("driver_id", "session", "block").applyInPandas(_decode_block, _PIECE)
    # path of the session up to each block: the cores before it and the steps between them; a block's own row comes before its stops
    order = Window.partitionBy("driver_id", "session").orderBy("block", F.asc_nulls_first("started_us"))
    pieces = pieces.withColumn("_last", F.last("core", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    east = F.pmod(F.col("core.lon0") - F.col("_last.lon1") + 180.0, F.lit(360.0)) - 180.0
    step = METRES * F.hypot(east * F.cos(F.radians((F.col("core.lat0") + F.col("_last.lat1")) / 2)), F.col("core.lat0") - F.col("_last.lat1"))
    base = F.sum(F.coalesce(F.col("_last.m") + step, F.lit(0.0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    pieces = pieces.withColumn("_base", base).where("first_ping_id IS NOT NULL")
    # pieces that a block's end parts are one stop again
    joined = F.coalesce(F.col("open_left") & F.lag("open_right").over(order), F.lit(False))
    pieces = pieces.withColumn("_stop", F.sum(F.when(joined, 0).otherwise(1)).over(order))
    whole = pieces.groupBy("driver_id", "session", "_stop").agg(
        F.min_by("first_ping_id", "started_us").alias("first_ping_id"), F.max_by("last_ping_id", "started_us").alias("last_ping_id"),
        F.min("started_us").alias("started_us"), F.max("ended_us").alias("ended_us"), F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"),
        F.min(F.col("_base") + F.col("from_m")).alias("from_m"), F.max(F.col("_base") + F.col("to_m")).alias("to_m"),
    )
    return whole.where(F.col("ended_us") - F.col("started_us") >= int(LEAST_S * 1e6)).drop("_stop")


def segments(pings: DataFrame) -> DataFrame:
    """Stops and trips: driver_id, segment_kind, first_ping_id, last_ping_id, started, ended, duration_s, distance_m.

    A trip leads from the last ping of a stop to the first ping of the next one in the same session. Distances are path
    totals over pings that aren't strays, summed over the blocks that a stop or trip reaches through.
    """
    order = Window.partitionBy("driver_id", "session").orderBy("started_us")
    found = stops(pings)
    after = lambda c: F.lead(c).over(order)
    found = found.withColumns({"_ping": after("first_ping_id"), "_at": after("started_us"), "_m": after("from_m")})
    stop = F.struct(F.lit("stop").alias("segment_kind"), "first_ping_id", "last_ping_id", "started_us", "ended_us", (F.col("to_m") - F.col("from_m")).alias("distance_m"))
    trip = F.when(F.col("_ping").isNotNull(), F.struct(F.lit("trip").alias("segment_kind"), F.col("last_ping_id").alias("first_ping_id"), F.col("_ping").alias("last_ping_id"), F.col("ended_us").alias("started_us"), F.col("_at").alias("ended_us"), (F.col("_m") - F.col("to_m")).alias("distance_m")))
    rows = found.select("driver_id", F.explode(F.array_compact(F.array(stop, trip))).alias("x")).select("driver_id", "x.*")
    return rows.select(
        "driver_id", "segment_kind", "first_ping_id", "last_ping_id", F.timestamp_micros("started_us").alias("started"), F.timestamp_micros("ended_us").alias("ended"),
        ((F.col("ended_us") - F.col("started_us")) / 1e6).alias("duration_s"), "distance_m",
    )

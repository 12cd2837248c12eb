"""Duplicates in streams: bounded by a watermark (event time) or by a time to live (processing time)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def within_watermark(events: DataFrame, keys: list[str], lateness_s: int = 86_400, time: str = "event_time") -> DataFrame:
    """The first arrival per key within the lateness; state is dropped as the watermark passes."""
    return events.withWatermark(time, f"{lateness_s} seconds").dropDuplicatesWithinWatermark(keys)


def time_to_live(events: DataFrame, keys: list[str], hours: float = 24) -> DataFrame:
    """The first arrival per key, and again after its time to live, which counts by processing time from the first arrival.

    The time of processing is the watermark here, so that Spark's own state with expiry serves and no row goes through
    Python. The stream must have no other watermark.
    """
    arrived = events.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", f"{int(hours * 3600)} seconds")
    return arrived.dropDuplicatesWithinWatermark(keys).drop("_arrived")


_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def timed_to_live(events: DataFrame, keys: list[str], clock: str, hours: float = 24, buckets: int = 4096) -> DataFrame:
    """The first arrival per key, and again `hours` after that one, exactly and by any clock column; timers end the state.

    Arrivals of one micro-batch count in the order of the clock; rows without a clock are left out. A call of Python costs
    as much as some thousand rows, so keys share a state by their hash: one time per key, without those that are over, and
    a timer at the last one's end. A batch rewrites the states that its keys fall into; `buckets` must stay as it is
    while a checkpoint is in use. Keys, which count as the same if their JSON is, clock and the other columns as JSON pass through Python.
    """
    schema = events.drop(clock).schema
    ttl = int(hours * 3_600_000_000)
    rows = events.where(F.col(clock).isNotNull()).withWatermark(clock, "0 seconds")
    key = [(F.col(k) + F.lit(0).cast(kind) if kind in ("float", "double") else F.col(k)).alias(k) for k, kind in events.select(*keys).dtypes]  # -0.0 is 0.0
    rows = rows.select(F.to_json(F.struct(*key), _EXACT).alias("_key"), F.unix_micros(clock).alias("_us"), F.col(clock).alias("_clock"), F.to_json(F.struct(*schema.names), _EXACT).alias("_row"))

    def run(bucket, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        firsts = json.loads(state.get[0]) if state.exists else {}
        arrived = sorted(x for pdf in batches for x in zip(pdf["_us"].tolist(), pdf["_row"].tolist(), pdf["_key"].tolist()))
        out = []
        for us, row, key in arrived:
            if key not in firsts or us - firsts[key] >= ttl:
                firsts[key] = us
                out.append((us, row))
        over = state.getCurrentWatermarkMs()
        firsts = {key: us for key, us in firsts.items() if (us + ttl) // 1000 > over}
        if firsts:
            state.update((json.dumps(firsts),))
            state.setTimeoutTimestamp((max(firsts.values()) + ttl) // 1000)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["_us", "_row"])

    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))
    kept = rows.groupBy("_bucket").applyInPandasWithState(run, "_us bigint, _row string", "firsts string", "append", GroupStateTimeout.EventTimeTimeout)
    time = F.timestamp_micros("_us").cast(events.schema[clock].dataType).alias(clock)
    return kept.select(time, F.from_json("_row", schema, _EXACT).alias("x")).select(clock, "x.*").select(*events.columns)


def per_batch(batch: DataFrame, key: str = "event_id", arrival: str = "ingest_time") -> DataFrame:
    """The earliest arrival per key within one micro-batch only; for use in foreachBatch."""
    rest = [c for c in batch.columns if c != key]
    first = batch.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(arrival, F.xxhash64(*rest))).alias("x"))
    return first.select(key, "x.*").select(*batch.columns)

"""Streaming queries run to the end of what is there, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators import windows
from harborline.plans import views
from harborline.plans.reference_queries import ORACLE as BATCH
from harborline.session import comparable, scratch_path
from harborline.sources import messages
from harborline.streaming import pipeline, state


def _events(spark, sf) -> DataFrame:
    """The table events as a stream of clean events."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    raw = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
    raw = raw.withColumn("ts", raw["ts"].cast("timestamp"))
    return spark.sql(views.silver_sql("spark"), events=raw)


def _drained(stream: DataFrame, mode: str) -> DataFrame:
    """The rows of a stream once all is read; a complete result replaces the one of the batch before."""
    spark, out = stream.sparkSession, scratch_path(stream.sparkSession, "stream")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    keep = lambda df, n: df.write.mode("overwrite").parquet(f"{out}/rows" if mode == "complete" else f"{out}/rows/batch={n}")
    q = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{out}/rows").select(*stream.columns)


def st_dedupe_within_watermark(spark, sf):
    """First arrivals by key within the lateness."""
    twice = spark.sql(views.silver_dup_sql("spark"), silver=_events(spark, sf))
    return comparable(_drained(state.within_watermark(twice, ["event_type", "event_id"]).select("event_id", "event_type"), "append"))


def st_tumbling(spark, sf):
    """Counts per domain and window."""
    return comparable(_drained(windows.tumbling(_events(spark, sf).withWatermark("event_time", "86400 seconds"), ["domain"]), "complete"))


def st_session(spark, sf):
    """Counts per shipment and session."""
    return comparable(_drained(windows.session(_events(spark, sf).withWatermark("event_time", "86400 seconds"), ["shipment_id"]), "complete"))


def st_dedupe_ttl(spark, sf):
    """First arrivals by key within a time to live."""
    twice = spark.sql(views.silver_dup_sql("spark"), silver=_events(spark, sf))
    return comparable(_drained(state.time_to_live(twice.select("event_id", "event_type"), ["event_type", "event_id"]), "append"))


def st_pipeline(spark, sf):
    """The whole stream over raw messages: clean events by type."""
    out = scratch_path(spark, "pipeline")
    events = _events(spark, sf)
    body = F.to_json(F.struct("event_id", "event_type", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"), F.parse_json("payload").alias("payload")))
    raw = events.select(body.cast("binary").alias("data"), F.create_map(F.lit("source_system"), "source_system").alias("attributes"))
    pipeline.run(raw, pipeline.Settings(out, bronze=False), f"{out}/checkpoint").awaitTermination()
    return comparable(spark.read.parquet(f"{out}/events").groupBy("route", "event_type").agg(F.count("*").alias("n")))


#: Batches of arrival for streams that run several times: by day, with one event in fifty coming in the last batch.
_BATCH = "CASE WHEN {n} % 50 = 7 THEN 3 WHEN dayofmonth(event_time) <= 10 THEN 0 WHEN dayofmonth(event_time) <= 20 THEN 1 ELSE 2 END"
_NUMBERED = f"SELECT *, {_BATCH.format(n='CAST(substr(event_id, 5) AS BIGINT)')} AS b FROM ({views.SILVER})"
_ARRIVAL = _BATCH.format(n="CAST(substr(event_id, 5) AS BIGINT)")


def _arriving(spark, df: DataFrame, start, name: str = "arriving") -> None:
    """Runs a stream over df once per batch of arrival; start(stream, checkpoint) gives the running query."""
    path = scratch_path(spark, name)
    for k in range(4):
        df.where(F.expr(_ARRIVAL) == k).write.mode("append").parquet(f"{path}/rows")
        stream = spark.readStream.schema(df.schema).parquet(f"{path}/rows")
        start(stream, f"{path}/checkpoint").awaitTermination()


def st_sliding(spark, sf):
    """Counts per domain and overlapping window."""
    return comparable(_drained(windows.sliding(_events(spark, sf).withWatermark("event_time", "86400 seconds"), ["domain"]), "complete"))


def st_late_rows(spark, sf):
    """Windows closed by the watermark, each once; rows that come after that are dropped."""
    out = scratch_path(spark, "closed")

    def start(stream, checkpoint):
        counts = windows.tumbling(stream.withWatermark("event_time", "86400 seconds"), ["domain"])
        return counts.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _arriving(spark, views.silver(spark, sf).select("event_id", "event_time", "domain"), start)
    return comparable(spark.read.parquet(out))


def st_panes(spark, sf):
    """What each pane of each window adds."""
    out = scratch_path(spark, "panes")
    _arriving(spark, views.silver(spark, sf).select("event_id", "event_time", "domain"), lambda s, c: pipeline.run_panes(s, out, c, ["domain"], 3600, 432_000))
    return comparable(spark.read.parquet(f"{out}/deltas").groupBy("domain", "window_start", "window_end", "pane").agg(F.sum("n").alias("n")))


def st_global_trigger(spark, sf):
    """What each trigger adds to the counts over all time."""
    out = scratch_path(spark, "global")
    _arriving(spark, views.silver(spark, sf).select("event_id", "event_time", "domain"), lambda s, c: pipeline.run_panes(s, out, c, ["domain"], None))
    return comparable(spark.read.schema("domain string, n bigint, batch_id bigint").parquet(f"{out}/deltas"))


def st_per_batch(spark, sf):
    """Duplicates dropped within each batch only."""
    out = scratch_path(spark, "perbatch")
    write = lambda df, n: state.per_batch(df).write.mode("overwrite").parquet(f"{out}/batch={n}")
    _arriving(spark, views.silver_dup(spark, sf).select("event_id", "event_time", "ingest_time"), lambda s, c: s.writeStream.foreachBatch(write).option("checkpointLocation", c).trigger(availableNow=True).start())
    return comparable(spark.read.parquet(out).select("event_id", "ingest_time"))


def st_ttl_expiry(spark, sf):
    """A key counts again once its time to live is over, by the arrival as clock: copies come 2, 23, 24 and 50 hours after the event."""
    later = F.explode(F.when(F.substring_index("event_id", "-", -1).cast("long") % 3 == 0, F.array(*[F.lit(h) for h in (0, 2, 23, 24, 50)])).otherwise(F.array(F.lit(0)))).alias("h")
    rows = views.silver(spark, sf).select("event_id", "event_type", "event_time", later)
    rows = rows.select("event_id", "event_type", (F.col("event_time") + F.make_dt_interval(hours=F.col("h"))).alias("arrived"))
    path = scratch_path(spark, "ttl")
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    return comparable(_drained(state.timed_to_live(stream, ["event_type", "event_id"], "arrived"), "append"))


def _messages(events: DataFrame) -> DataFrame:
    body = F.to_json(F.struct("event_id", "event_type", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"), F.parse_json("payload").alias("payload")))
    return events.select(body.cast("binary").alias("data"), F.create_map(F.lit("source_system"), "source_system", F.lit("event_id"), "event_id", F.lit("event_time"), F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).alias("attributes"))


def st_message_source(spark, sf):
    """Messages read from a topic's folder, each identifier once."""
    path = scratch_path(spark, "topic")
    _messages(spark.sql(views.silver_dup_sql("spark"), silver=views.silver(spark, sf))).write.parquet(path)
    stream = messages.read_stream(spark, topic=path, id_attribute="event_id")
    return comparable(_drained(stream.select(F.col("attributes")["event_id"].alias("event_id"), F.col("attributes")["source_system"].alias("source_system")), "append"))


def _piped(spark, sf, **settings) -> str:
    """The folder of a pipeline run as a stream over all events."""
    out = scratch_path(spark, "pipeline")
    pipeline.run(_messages(_events(spark, sf)), pipeline.Settings(out, **settings), f"{out}/checkpoint").awaitTermination()
    for q in spark.streams.active:  # the raw archive
        q.awaitTermination()
    return out


def st_silver_rows(spark, sf):
    """Clean rows of the delivery domain, as the stream wrote them."""
    rows = spark.read.parquet(f"{_piped(spark, sf, bronze=False)}/silver/delivery_events")
    return comparable(rows.select("event_id", "event_type", "event_time", "event_version", "source_system", "dedupe_key", "delivery_id", "shipment_id", "driver_id", "facility_id"))


def st_bronze_lines(spark, sf):
    """JSON lines of all events by domain, day and hour, as the stream wrote them; names are masked in them."""
    lines = spark.read.text(f"{_piped(spark, sf)}/bronze")
    get = lambda p: F.get_json_object("value", f"$.{p}")
    return comparable(lines.select("domain", F.col("event_date").cast("string").alias("event_date"), F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour"), get("event_id").alias("event_id"), get("payload.facility_name").alias("facility_name"), get("payload.location.latitude").cast("double").alias("latitude")))


def st_raw_archive(spark, sf):
    """Messages as they came."""
    rows = spark.read.parquet(f"{_piped(spark, sf, raw_archive=True, bronze=False)}/raw")
    return comparable(rows.select(F.get_json_object(F.col("data").cast("string"), "$.event_id").alias("event_id"), F.col("attributes")["source_system"].alias("source_system")))


def st_replay(spark, sf):
    """Events by type after dead letters were mended and sent through again."""
    out = scratch_path(spark, "replay")
    n = F.substring_index("event_id", "-", -1).cast("long")
    sent = views.silver(spark, sf).withColumn("event_type", F.when(n % 40 == 1, "nodot").otherwise(F.col("event_type")))
    settings = pipeline.Settings(out, bronze=False)
    pipeline.run_once(_messages(sent), settings)
    again = pipeline.replay(spark.read.parquet(f"{out}/dead_letters"))
    mended = again.withColumn("data", F.regexp_replace(F.col("data").cast("string"), '"event_type":"nodot"', '"event_type":"driver.mended"').cast("binary"))
    pipeline.write_batch(pipeline.checked(mended, settings), 1, settings)
    return comparable(spark.read.parquet(f"{out}/events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids")))


def st_attempts(spark, sf):
    """Batches whose sink fails twice are written, those whose sink always fails become dead letters after five attempts."""
    out = scratch_path(spark, "attempts")
    calls: dict[int, int] = {}

    def write(df, n):
        calls[n] = calls.get(n, 0) + 1
        if n == 2 or (n == 1 and calls[n] < 3):
            raise OSError("the sink is away")
        df.write.mode("overwrite").parquet(f"{out}/written/batch={n}")

    run = pipeline.attempted(write, f"{out}/dead", sleep=lambda s: None)
    _arriving(spark, views.silver(spark, sf).select("event_id", "event_time", "domain"), lambda s, c: s.writeStream.foreachBatch(run).option("checkpointLocation", c).trigger(availableNow=True).start())
    dead = spark.read.parquet(f"{out}/dead").select(F.get_json_object(F.col("data").cast("string"), "$.event_id").alias("event_id"), F.col("attributes")["delivery_attempt"].alias("attempts"))
    return comparable(spark.read.parquet(f"{out}/written").select("event_id", F.lit(None).cast("string").alias("attempts")).unionByName(dead))


QUERIES = {"st_dedupe_within_watermark": st_dedupe_within_watermark, "st_dedupe_ttl": st_dedupe_ttl, "st_tumbling": st_tumbling, "st_session": st_session, "st_pipeline": st_pipeline}
QUERIES |= {f.__name__: f for f in (st_sliding, st_late_rows, st_panes, st_global_trigger, st_per_batch, st_ttl_expiry, st_message_source, st_silver_rows, st_bronze_lines, st_raw_archive, st_replay, st_attempts)}
_DISTINCT = f"SELECT DISTINCT event_id, event_type FROM ({views.SILVER_DUP})"
ORACLE = {
    "st_dedupe_within_watermark": _DISTINCT,
    "st_dedupe_ttl": _DISTINCT,
    "st_tumbling": BATCH["q_tumbling_counts"],
    "st_session": BATCH["q_session_counts"],
    "st_pipeline": f"SELECT CASE WHEN domain IN ('shipment', 'facility', 'driver', 'delivery') THEN domain ELSE 'other' END AS route, event_type, count(*) AS n FROM ({views.SILVER}) GROUP BY ALL",
}
_P = lambda path: f"json_extract_string(payload, '$.{path}')"
_HOURS = "CASE WHEN CAST(substr(event_id, 5) AS BIGINT) % 3 = 0 THEN [0, 24, 50] ELSE [0] END"
_REACHED = f"""s AS ({_NUMBERED}), w AS (SELECT b, max(epoch_us(max(event_time))) OVER (ORDER BY b) AS wm FROM s GROUP BY b),
    r AS (SELECT s.*, w.wm, p.wm AS previous FROM s JOIN w USING (b) LEFT JOIN w p ON p.b = s.b - 1)"""
ORACLE |= {
    "st_sliding": BATCH["q_sliding_counts"],
    "st_late_rows": f"""
        WITH {_REACHED}, t AS (SELECT domain, epoch_us(event_time) - epoch_us(event_time) % 300000000 AS window_start, previous FROM r)
        SELECT domain, window_start, window_start + 300000000 AS window_end, count(*) AS n FROM t
        WHERE (previous IS NULL OR window_start + 300000000 > previous - 86400000000) AND window_start + 300000000 <= (SELECT max(wm) FROM w) - 86400000000 GROUP BY ALL""",
    "st_panes": f"""
        WITH {_REACHED}, t AS (SELECT domain, epoch_us(event_time) - epoch_us(event_time) % 3600000000 AS window_start, wm, previous FROM r)
        SELECT domain, window_start, window_start + 3600000000 AS window_end,
               CASE WHEN wm < window_start + 3600000000 THEN 'early' WHEN previous IS NULL OR previous < window_start + 3600000000 THEN 'on_time' ELSE 'late' END AS pane, count(*) AS n
        FROM t WHERE previous IS NULL OR window_start + 3600000000 + 432000000000 > previous GROUP BY ALL""",
    "st_global_trigger": f"SELECT domain, CAST(b AS BIGINT) AS batch_id, count(*) AS n FROM ({_NUMBERED}) GROUP BY ALL",
    "st_per_batch": f"""SELECT event_id, epoch_us(min(ingest_time)) AS ingest_time FROM (SELECT *, {_ARRIVAL} AS b FROM ({views.SILVER_DUP})) GROUP BY event_id, b""",
    "st_ttl_expiry": f"SELECT event_id, event_type, epoch_us(event_time) + h * 3600000000 AS arrived FROM (SELECT event_id, event_type, event_time, unnest({_HOURS}) AS h FROM ({views.SILVER})) ",
    "st_message_source": f"SELECT DISTINCT event_id, source_system FROM ({views.SILVER_DUP})",
    "st_silver_rows": f"""SELECT event_id, event_type, epoch_us(event_time) AS event_time, event_version, source_system, dedupe_key, {_P('delivery_id')} AS delivery_id, {_P('shipment_id')} AS shipment_id,
        {_P('driver_id')} AS driver_id, {_P('facility_id')} AS facility_id FROM ({views.SILVER}) WHERE domain = 'delivery'""",
    "st_bronze_lines": f"""SELECT domain, strftime(event_time, '%Y-%m-%d') AS event_date, strftime(event_time, '%H') AS hour, event_id,
        array_to_string(list_transform(string_split({_P('facility_name')}, ' '), lambda w: CASE WHEN length(w) > 1 THEN w[1] || repeat('*', length(w) - 1) ELSE w END), ' ') AS facility_name, CAST({_P('location.latitude')} AS DOUBLE) AS latitude FROM ({views.SILVER})""",
    "st_raw_archive": f"SELECT event_id, source_system FROM ({views.SILVER})",
    "st_replay": f"""SELECT CASE WHEN CAST(substr(event_id, 5) AS BIGINT) % 40 = 1 THEN 'driver.mended' ELSE event_type END AS event_type, count(*) AS n, count(DISTINCT event_id) AS ids
        FROM ({views.SILVER}) GROUP BY 1""",
    "st_attempts": f"SELECT event_id, CASE WHEN b = 2 THEN '5' END AS attempts FROM ({_NUMBERED})",
}

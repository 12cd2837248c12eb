"""The platform's stream: messages to bronze files, clean tables and dead letters, from the operators the batches use."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harborline.config import Streaming
from harborline.functions import masking
from harborline.operators import enrich, normalize, route, validate, windows
from harborline.sources import sinks
from harborline.streaming.metrics import counted
from harborline.types import DOMAINS


@dataclass
class Settings:
    out: str
    streaming: Streaming = field(default_factory=Streaming)
    schemas: dict[str, dict] = field(default_factory=dict)
    dims: dict[str, DataFrame] = field(default_factory=dict)
    mask_key: bytes | None = None
    exempt: frozenset[str] = frozenset()
    #: Events as JSON lines by domain, day and hour; messages just as they came, before anything is done to them.
    bronze: bool = True
    raw_archive: bool = False


def checked(messages: DataFrame, settings: Settings, ingest_time: Column | None = None, new_id: Column | None = None) -> DataFrame:
    """Envelopes with errors and a key; repeats of a key within the lateness are dropped when messages are a stream.

    Without an identifier of its own, a message's id is a hash of its body. An invalid message's key is a hash as well, so
    that it isn't taken for a repeat of a valid one.
    """
    new_id = F.sha2(F.coalesce("data", F.lit(b"")), 256) if new_id is None else new_id
    events = validate.validated(normalize.normalize(messages, ingest_time, new_id), settings.schemas)
    events = counted(events, "validation", valid=F.size("errors") == 0, invalid=F.size("errors") > 0)
    digest = F.sha2(F.concat_ws("|", "event_id", "event_type", "payload"), 256)
    events = events.withColumn("_key", F.when(F.size("errors") == 0, F.concat_ws(":", "event_type", "event_id")).otherwise(F.concat(F.lit("invalid:"), digest)))
    lateness = f"{settings.streaming.allowed_lateness_seconds} seconds"
    if events.isStreaming:
        return events.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["_key"]).drop("_key")
    order = F.struct("ingest_time", "event_time", digest)
    rest = [c for c in events.columns if c != "_key"]
    return events.groupBy("_key").agg(F.min_by(F.struct(*rest), order).alias("x")).select("x.*")


def finished(valid: DataFrame, settings: Settings) -> DataFrame:
    """Valid envelopes with dimensions put into the payload and personal fields masked."""
    if settings.dims:
        valid = enrich.enrich(valid, **settings.dims)
        extra = [c for c in ("_facility", "_carrier", "_driver") if c in valid.columns]
        whole = F.from_json("payload", "map<string,variant>")
        pairs = [F.when(F.coalesce(*[F.col(c)[f] for f in valid.schema[c].dataType.names]).isNotNull(), F.create_map(F.lit(c), F.parse_json(F.to_json(F.col(c))))).otherwise(F.from_json(F.lit("{}"), "map<string,variant>")) for c in extra]
        valid = valid.withColumn("payload", F.to_json(F.map_concat(whole, *pairs))).drop(*extra)
    if settings.streaming.enable_pii_masking:
        valid = valid.withColumn("payload", masking.mask_payload(F.col("payload"), settings.mask_key, exempt=set(settings.exempt)))
    return valid


def write_batch(events: DataFrame, batch_id: int, settings: Settings) -> None:
    """One micro-batch to all sinks, each under its batch number, so that a repeated batch replaces itself."""
    spark = events.sparkSession
    path = f"{settings.out}/_batches/{batch_id}"
    events.write.mode("overwrite").parquet(path)
    events = spark.read.schema(events.schema).parquet(path)  # a batch without rows has files without a schema
    valid, invalid = validate.split(events)
    dead = route.dead_letters(invalid).withColumn("batch_id", F.lit(batch_id))
    dead.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{settings.out}/dead_letters")
    done = route.with_route(finished(valid, settings))
    whole = f"{settings.out}/_finished/{batch_id}"
    done.write.mode("overwrite").partitionBy("route").parquet(whole)
    done = spark.read.schema(done.schema).parquet(whole)
    if settings.bronze:
        sinks.bronze_json(done.drop("route"), f"{settings.out}/bronze/batch_id={batch_id}", mode="overwrite")
    bronze = done.withColumns({"event_date": F.to_date("event_time"), "batch_id": F.lit(batch_id)})
    bronze.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("route", "event_date", "batch_id").parquet(f"{settings.out}/events")
    for d in DOMAINS:  # a domain's rows are one folder, which alone is read
        rows = sinks.silver_rows(done.where(F.col("route") == d), d).withColumns({"event_date": F.to_date("event_time"), "batch_id": F.lit(batch_id)})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(f"{settings.out}/silver/{d}_events")


def run(messages: DataFrame, settings: Settings, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start the stream; without `every`, what is there now is processed and the query ends. The raw archive is a stream of its own."""
    if settings.raw_archive:
        raw = messages.select("data", "attributes").writeStream.format("parquet").option("path", f"{settings.out}/raw").option("checkpointLocation", f"{checkpoint}-raw")
        (raw.trigger(processingTime=every) if every else raw.trigger(availableNow=True)).start()
    writer = checked(messages, settings).writeStream.foreachBatch(lambda df, n: write_batch(df, n, settings)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def run_once(messages: DataFrame, settings: Settings, **given: Column) -> None:
    """The same over a batch of messages, as batch 0."""
    write_batch(checked(messages, settings, **given), 0, settings)


def replay(dead_letters: DataFrame) -> DataFrame:
    """Dead letters as messages again."""
    return dead_letters.select("data", "attributes")


def attempted(write: Callable[[DataFrame, int], None], dead_path: str, most: int = 5, wait_s: tuple[float, float] = (10, 600), sleep: Callable[[float], None] = time.sleep) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that tries `write` up to `most` times, waiting longer each time; then the batch becomes dead letters.

    Dead letters are (data, attributes) with the number of attempts and the error; they replace themselves if the batch
    is repeated, and the stream goes on.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(1, most + 1):
            try:
                write(batch, batch_id)
                return
            except Exception as e:  # noqa: BLE001
                said = type(e).__name__
                if attempt < most:
                    sleep(min(wait_s[1], wait_s[0] * 2 ** (attempt - 1)))
        body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns]), {"ignoreNullFields": "false"}).cast("binary")
        attributes = F.create_map(F.lit("delivery_attempt"), F.lit(str(most)), F.lit("error"), F.lit(said))
        batch.select(body.alias("data"), attributes.alias("attributes")).write.mode("overwrite").parquet(f"{dead_path}/batch_id={batch_id}")

    return run


def window_deltas(batch: DataFrame, batch_id: int, keys: list[str], seconds: int | None = 300) -> DataFrame:
    """Counts a micro-batch adds to each window (discarding panes), or to each key over all time; consumers sum over batch_id."""
    counts = windows.tumbling(batch, keys, seconds) if seconds else windows.everlasting(batch, keys)
    return counts.withColumn("batch_id", F.lit(batch_id).cast("long"))


def run_panes(events: DataFrame, out: str, checkpoint: str, keys: list[str], seconds: int | None = 300, lateness_s: int = 86_400, every: str | None = None) -> StreamingQuery:
    """Write what each trigger adds to its windows to `out`, with its pane; without `seconds`, to one window over all time.

    The watermark is the latest event time seen. A delta is early before it passes the window's end, on_time in the batch
    in which it does, late after that; windows that ended more than the lateness before the batch take nothing more. Each
    batch writes under its number, so that a repeated one replaces itself.
    """

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        deltas = window_deltas(batch, n, keys, seconds)
        if seconds:
            seen = spark.read.schema("watermark timestamp, batch_id bigint").parquet(f"{out}/watermarks").where(F.col("batch_id") < n) if n else spark.createDataFrame([], "watermark timestamp, batch_id bigint")
            before = seen.agg(F.max("watermark")).first()[0]
            now = max([x for x in (before, batch.agg(F.max("event_time")).first()[0]) if x is not None], default=None)
            spark.createDataFrame([(now,)], "watermark timestamp").write.mode("overwrite").parquet(f"{out}/watermarks/batch_id={n}")
            deltas = windows.panes(deltas.withColumn("previous_watermark", F.lit(before).cast("timestamp")), F.lit(now).cast("timestamp"), lateness_s).drop("previous_watermark")
        deltas.drop("batch_id").write.mode("overwrite").parquet(f"{out}/deltas/batch_id={n}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()

"""Exactly-once delivery: exact dictionary encoding and sharded seen-bitmaps.

Every event key (event type + canonical identifier), delivered or not, is encoded exactly as (segment, shard, ordinal).
One bit per ordinal says whether the event has been delivered. A batch is reduced to one candidate arrival per key; its
bit alone admits or drops it, and the bits of those admitted are united with the stored bitmaps. Dictionary, winners and
bitmaps of a batch become visible together, by the rename of one manifest file.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.session import materialize, plan_bytes

#: Bits in one bitmap of Spark's bitmap functions.
BUCKET_BITS = 32768
#: Input bytes that one shard of a segment is meant for.
SHARD_BYTES = 64 << 20
#: A batch of at most so many keys reads only the shards it touches; bitmaps written by so many batches are put together.
TOUCHED, COMPACTED = 10_000, 16
#: Batches that a whole table is delivered in.
BATCHES = 4
_BLANKS = " \t\r\n\f\v\u00a0"
_FAR = 9_000_000_000_000_000_000


def canonical_id(c: Column) -> Column:
    """One spelling of an identifier: UUIDs as 32 lower-case hex digits, anything else trimmed and lower-cased."""
    plain = F.lower(F.btrim(c, F.lit(_BLANKS)))
    bare = F.translate(F.replace(plain, F.lit("urn:uuid:"), F.lit("")), "{}()-" + _BLANKS, "")
    return F.when(bare.rlike("^[0-9a-f]{32}$"), bare).otherwise(plain)


def event_key(event_type: Column, event_id: Column) -> Column:
    """Key of an event; null where the identifier is null, as such a row can't be told to be a copy."""
    return F.concat(F.coalesce(F.lower(F.trim(event_type)), F.lit("")), F.lit(":"), canonical_id(event_id))


def arrival_order(ingest_time: Column, row_id: Column) -> Column:
    """(ingest_time, row_id) as one decimal, so that its minimum is found by hash aggregation; nulls come last."""
    at = F.coalesce(F.unix_micros(ingest_time), F.lit(_FAR)).cast("decimal(19,0)")
    return at * F.lit("1" + "0" * 19).cast("decimal(20,0)") + F.coalesce(row_id, F.lit(_FAR)).cast("decimal(19,0)")


def keyed(df: DataFrame, event_type="event_type", event_id="event_id", ingest_time="ingest_time", row_id="message_id"):
    """df with `_key` and `_ord`."""
    return df.withColumns({"_key": event_key(F.col(event_type), F.col(event_id)), "_ord": arrival_order(F.col(ingest_time), F.col(row_id))})


def first_arrivals(rows: DataFrame) -> DataFrame:
    """One candidate (_key, _ord) per key; combines on the map side, so that a hot key never meets in one task."""
    return rows.where("_key IS NOT NULL").groupBy("_key").agg(F.min("_ord").alias("_ord"))


class SeenStore:
    """Dictionary and seen-bitmaps in a folder shared by all executors.

    manifest.json names what has been published: the dictionary's segments, each with shards by its own size, the winners
    of each batch, and the bitmaps. Files that it doesn't name are ignored, so a failed batch leaves no trace and can be
    repeated. One writer at a time.
    """

    _WINNERS = "segment INT, shard INT, ordinal BIGINT, _key STRING, _ord DECIMAL(38,0)"

    def __init__(self, spark: SparkSession, path: str, shards: int | None = None):
        self.spark, self.path, self._wanted = spark, path.rstrip("/"), shards
        jvm = spark.sparkContext._jvm
        self._hpath, self._rename = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.Options.Rename
        self._fs = self._hpath(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def manifest(self) -> dict:
        if not self._fs.exists(self._hpath(f"{self.path}/manifest.json")):
            return {"segments": [], "batches": [], "bitmaps": []}
        return json.loads("\n".join(r.value for r in self.spark.read.text(f"{self.path}/manifest.json").collect()))

    def _publish(self, manifest: dict) -> None:
        tmp = self._hpath(f"{self.path}/.manifest-{uuid.uuid4().hex}")
        out = self._fs.create(tmp)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        final = self._hpath(f"{self.path}/manifest.json")
        options = self.spark.sparkContext._gateway.new_array(self._rename, 1)
        options[0] = self._rename.OVERWRITE
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf).rename(tmp, final, options)

    def _new_path(self, kind: str) -> str:
        return f"{self.path}/{kind}-{uuid.uuid4().hex}"

    def dictionary(self, touched: DataFrame | None = None) -> DataFrame:
        """(segment, shard, ordinal, _key) of every identifier; with `touched`, only of the shards that these keys are in."""
        out = self.spark.createDataFrame([], "segment INT, shard INT, ordinal BIGINT, _key STRING")
        for n, segment in enumerate(self.manifest()["segments"]):
            part = self.spark.read.schema("ordinal BIGINT, _key STRING, shard INT").parquet(segment["path"])
            if touched is not None:
                part = part.where(F.col("shard").isin([r[0] for r in touched.select(_shard(segment["shards"])).distinct().collect()]))
            out = out.unionByName(part.withColumn("segment", F.lit(n)))
        return out

    def winners(self, batches: list[str] | None = None) -> DataFrame:
        """(segment, shard, ordinal, _key, _ord) of the kept arrival of each event."""
        paths = self.manifest()["batches"] if batches is None else batches
        return self.spark.read.schema(self._WINNERS).parquet(*paths) if paths else self.spark.createDataFrame([], self._WINNERS)

    def bitmaps(self) -> DataFrame:
        """(segment, shard, bucket, bits): the union of what the batches have set."""
        paths, schema = self.manifest()["bitmaps"], "segment INT, shard INT, bucket BIGINT, bits BINARY"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return _united(self.spark.read.schema(schema).parquet(*paths))

    def encode(self, arrivals: DataFrame) -> tuple[DataFrame, dict | None]:
        """arrivals (one row per _key) with segment, shard and ordinal, and the dictionary's new segment, not yet published.

        Ordinals count within a shard, whose size is bounded as the shards of a segment follow its size.
        """
        segments = self.manifest()["segments"]
        rest = [c for c in arrivals.columns if c != "_key"]
        code, new = ["segment", "shard", "ordinal"], arrivals
        if segments:
            arrivals = materialize(arrivals, "arrivals")
            known = self.dictionary(arrivals if arrivals.count() <= TOUCHED else None)
            coded = materialize(arrivals.join(known, "_key", "left"), "coded")
            new = coded.where("ordinal IS NULL").select("_key", *rest)
        shards = int(self._wanted or max(16, plan_bytes(new) // SHARD_BYTES))
        fresh = new.withColumn("shard", _shard(shards))
        fresh = fresh.withColumn("ordinal", F.expr("CAST(row_number() OVER (PARTITION BY shard ORDER BY _key) - 1 AS BIGINT)"))
        path = self._new_path("segment")
        fresh.select("ordinal", "_key", *rest, "shard").write.option("compression", "zstd").partitionBy("shard").parquet(path)
        schema = T.StructType([f for f in fresh.schema if f.name != "shard"] + [T.StructField("shard", T.IntegerType())])
        fresh = self.spark.read.schema(schema).parquet(path).withColumn("segment", F.lit(len(segments))).select(*code, "_key", *rest)
        encoded = fresh.unionByName(coded.where("ordinal IS NOT NULL").select(*code, "_key", *rest)) if segments else fresh
        return encoded, {"path": path, "shards": shards}

    def admit(self, candidates: DataFrame, segment: dict | None = None) -> str:
        """Publish the candidates (encoded, with _ord) whose bit isn't set as a batch, with their bits and a new segment; returns the batch."""
        state = self.manifest()
        if segment:
            state["segments"].append(segment)
        if state["bitmaps"]:
            candidates = candidates.withColumn("word", F.expr("ordinal div 32")).join(_bit_words(self.bitmaps()), ["segment", "shard", "word"], "left")
            place = F.expr("CAST((3 - ordinal % 32 div 8) * 8 + ordinal % 8 AS INT)")
            candidates = candidates.where(F.coalesce(F.getbit("bits", place), F.lit(0)) == 0)
        batch, delta = self._new_path("batch"), self._new_path("bitmaps")
        candidates.select("segment", "shard", "ordinal", "_key", "_ord").write.option("compression", "zstd").parquet(batch)
        bits = self.winners([batch]).groupBy("segment", "shard", F.expr(f"ordinal div {BUCKET_BITS}").alias("bucket"))
        bits = bits.agg(F.bitmap_construct_agg(F.expr(f"ordinal % {BUCKET_BITS}")).alias("bits"))
        if len(state["bitmaps"]) >= COMPACTED:
            bits, state["bitmaps"] = _united(bits.unionByName(self.bitmaps())), []
        bits.write.option("compression", "zstd").parquet(delta)
        self._publish({"segments": state["segments"], "batches": [*state["batches"], batch], "bitmaps": [*state["bitmaps"], delta]})
        return batch

    def deliver(self, rows: DataFrame) -> DataFrame:
        """Admit a batch of keyed rows; returns its winners, one per event not delivered before.

        Rows with a null key are no events of the store and are left to the caller. An empty batch publishes nothing new
        but itself. The batch with the earlier call wins over a later one, whatever the arrival times.
        """
        encoded, segment = self.encode(first_arrivals(rows))
        return self.winners([self.admit(encoded, segment)])

    def deliver_in_order(self, rows: DataFrame, at: str, batches: int = BATCHES) -> DataFrame:
        """Admit keyed rows in batches by the time `at`, earliest first; returns the winners of these batches.

        The identifiers of all rows are encoded first, with an event's first arrival in each batch; from then on the bits
        decide. A time is in one batch only and rows without one are in the last, so the winner is the earliest arrival.
        """
        us = F.unix_micros(at)
        cuts = sorted(set(rows.select(us.alias("us")).approxQuantile("us", [n / batches for n in range(1, batches)], 0.01)))
        cuts = [int(c) for c in cuts]
        number = F.coalesce(sum((F.when(us >= c, 1).otherwise(0) for c in cuts), F.lit(0)), F.lit(0))
        number = F.when(us.isNull(), len(cuts)).otherwise(number)
        firsts = [F.min(F.when(number == n, F.col("_ord"))).alias(f"_ord{n}") for n in range(len(cuts) + 1)]
        encoded, segment = self.encode(rows.where("_key IS NOT NULL").groupBy("_key").agg(*firsts))
        done = []
        for n in range(len(cuts) + 1):
            done.append(self.admit(encoded.withColumn("_ord", F.col(f"_ord{n}")).where("_ord IS NOT NULL"), segment if n == 0 else None))
        return self.winners(done)


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("_key"), F.lit(shards)).cast("int")


def _united(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("segment", "shard", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _bit_words(bitmaps: DataFrame) -> DataFrame:
    """(segment, shard, word, bits): the words of 32 bits with any bit set, each as a number."""
    each = bitmaps.select("segment", "shard", "bucket", "bits", F.explode(F.sequence(F.lit(0), F.lit(BUCKET_BITS // 32 - 1))).alias("n"))
    word = F.conv(F.hex(F.expr("substring(bits, n * 4 + 1, 4)")), 16, 10).cast("bigint")
    return each.select("segment", "shard", (F.col("bucket") * (BUCKET_BITS // 32) + F.col("n")).alias("word"), word.alias("bits")).where("bits <> 0")


def copies(rows: DataFrame, winners: DataFrame, row_id: str = "message_id") -> DataFrame:
    """Each keyed row that isn't the kept copy of its event, as (row_id); repeated rows come as often as they repeat.

    Joined on (_key, _ord), which spreads the copies of a hot event. Rows with a null key are never copies.
    """
    grouped = rows.where("_key IS NOT NULL").groupBy("_key", "_ord").agg(F.count("*").alias("n"), F.first(row_id).alias(row_id))
    kept = winners.select("_key", "_ord", F.lit(1).alias("kept"))
    left = grouped.join(kept, ["_key", "_ord"], "left").withColumn("n", F.col("n") - F.coalesce("kept", F.lit(0)))
    return left.where("n > 0").select(F.explode(F.array_repeat(row_id, F.col("n").cast("int"))).alias(row_id))


def keep_first(df: DataFrame, store: SeenStore | None = None, **columns: str) -> DataFrame:
    """df with exactly one row per event: of those delivered earliest, the one with the smallest row id.

    Rows without an identifier are kept; rows without an ingest time come last, those without a row id last of a tie; of
    rows that repeat in full one is kept. Columns of any name come through as they are. One pass over df, in which rows
    combine before the shuffle. With a store, events of earlier batches are dropped too.
    """
    named = {k: f"row.{columns.get(k, v)}" for k, v in (("event_type", "event_type"), ("event_id", "event_id"), ("ingest_time", "ingest_time"), ("row_id", "message_id"))}
    rows = keyed(df.select(F.struct("*").alias("row")), **named)
    if store:
        kept = rows.join(store.deliver(rows).select("_key", "_ord"), ["_key", "_ord"], "left_semi").dropDuplicates(["_key", "_ord"])
        return kept.unionByName(rows.where("_key IS NULL")).select("row.*")
    return first_rows(rows, "row").select("row.*")


def first_rows(rows: DataFrame, *values: str) -> DataFrame:
    """The values of the first arrival of each key of keyed rows, in one pass; rows with a null key stay, each on its own."""
    alone = F.when(F.col("_key").isNull(), F.monotonically_increasing_id()).alias("_alone")
    return rows.groupBy("_key", alone).agg(F.min_by(F.struct(*values), "_ord").alias("_x")).select("_x.*")

"""Message sources: (data binary, attributes map<string,string>), batch and streaming, one or several topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "data binary, attributes map<string,string>"


def read_stream(spark: SparkSession, subscription: str | None = None, topic: str | None = None, files_per_trigger: int | None = None, id_attribute: str | None = None, time_attribute: str = "event_time", lateness_s: int = 86_400) -> DataFrame:
    """Messages from a folder of files as they arrive; with id_attribute, repeats of an id within the lateness are dropped.

    The folder is that of the subscription, else that of the topic.
    """
    path = subscription or topic
    if not path:
        raise ValueError("a subscription or a topic is needed")
    reader = spark.readStream.schema(SCHEMA).format("parquet")
    df = (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(path)
    if id_attribute:
        at = F.coalesce(F.col("attributes")[time_attribute].try_cast("timestamp"), F.current_timestamp())
        df = df.withColumns({"_at": at, "_id": F.col("attributes")[id_attribute]}).withWatermark("_at", f"{lateness_s} seconds").dropDuplicatesWithinWatermark(["_id"]).drop("_at", "_id")
    return df


def read_batch(spark: SparkSession, path: str, max_messages: int = 1000) -> DataFrame:
    """One bounded pull of at most max_messages messages."""
    return spark.read.schema(SCHEMA).parquet(path).limit(max_messages)


def tagged_union(topics: dict[str, DataFrame]) -> DataFrame:
    """All topics as one, each message with its topic as attribute `_source_topic`; null attributes count as none."""
    out = None
    for name, df in topics.items():
        empty = F.create_map().cast("map<string,string>")
        kept = F.map_filter(F.coalesce("attributes", empty), lambda k, _: k != "_source_topic")
        tagged = df.withColumn("attributes", F.map_concat(kept, F.create_map(F.lit("_source_topic"), F.lit(name))))
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("no topics given")
    return out

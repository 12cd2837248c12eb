"""Bronze files, clean (silver) rows, gold tables, the dead letter table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions import envelope, jsontext
from harborline.operators.normalize import to_json_line
from harborline.types import PROMOTED, silver


def bronze_json(events: DataFrame, path: str, per_file: int = 10_000, mode: str = "append") -> None:
    """Envelopes as JSON lines under domain/event_date/hour."""
    d = envelope.domain(F.col("event_type"))
    cols = {"domain": d, "event_date": F.date_format("event_time", "yyyy-MM-dd"), "hour": F.date_format("event_time", "HH")}
    lines = to_json_line(events.select("event_id", "event_type", "event_version", "event_time", "ingest_time", "source_system", "payload", "trace_id"))
    parts = F.from_json("value", "event_type string, event_time timestamp")
    rows = lines.withColumn("_e", parts).select("value", envelope.domain(F.col("_e.event_type")).alias("domain"), F.date_format("_e.event_time", "yyyy-MM-dd").alias("event_date"), F.date_format("_e.event_time", "HH").alias("hour"))
    rows.write.mode(mode).option("maxRecordsPerFile", per_file).partitionBy(*cols).text(path)


def bronze_parquet(events: DataFrame, path: str, per_file: int = 1_000_000) -> None:
    """Envelopes as Parquet under event_date."""
    events.withColumn("event_date", F.to_date("event_time")).write.mode("append").option("maxRecordsPerFile", per_file).partitionBy("event_date").parquet(path)


def bronze_avro(events: DataFrame, path: str) -> None:
    """Envelopes as Avro with times as text; needs the spark-avro package."""
    rows = events.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX") for c in ("event_time", "ingest_time")})
    try:
        rows.write.mode("append").format("avro").save(path)
    except Exception as e:
        if "avro" in str(e).lower():
            raise RuntimeError("the spark-avro package is not on the class path") from e
        raise


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(r.title() for r in rest)


def silver_rows(events: DataFrame, domain: str, camel_case: bool = False) -> DataFrame:
    """Envelopes of a domain in its clean schema; promoted ids come from the payload, by snake-case key unless camel_case."""

    names = PROMOTED.get(domain, [])
    ids = jsontext.Scalars("payload", names + [_camel(n) for n in names])

    def promoted(name: str):
        return (F.coalesce(ids.get(name), ids.get(_camel(name))) if camel_case else ids.get(name)).alias(name)

    key = envelope.dedupe_key(F.col("event_type"), F.col("event_id")).alias("dedupe_key")
    common = [F.col(f.name) if f.name != "dedupe_key" else key for f in silver(domain).fields if f.name not in PROMOTED.get(domain, [])]
    events = events.withColumn("_scalars", ids.column()) if names else events
    return events.select(*common, *[promoted(c) for c in PROMOTED.get(domain, [])])


def write_silver(events: DataFrame, path: str, domain: str) -> None:
    """Append a domain's rows, by event_date; a filter on event_date prunes folders, one on event_time reaches the files."""
    silver_rows(events, domain).withColumn("event_date", F.to_date("event_time")).write.mode("append").partitionBy("event_date").parquet(f"{path}/{domain}_events")


def write_gold(df: DataFrame, path: str, partition: str, append: bool = False) -> None:
    """Write a gold table; its partitions present in df are replaced, so that a day can be built again. append adds instead."""
    w = df.write.partitionBy(partition)
    (w.mode("append") if append else w.mode("overwrite").option("partitionOverwriteMode", "dynamic")).parquet(path)


def delete_rows(spark: SparkSession, path: str, partition: str, before: str) -> int:
    """Drop partitions of a gold or silver table older than a date; returns how many."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(f"{partition}=") and s.getPath().getName().split("=", 1)[1] < before]
    return sum(bool(fs.delete(p, True)) for p in old)

"""History of changing attributes: gaps and islands over full snapshots.

Partial updates are reduced to one per (entity, time), carried forward to full snapshots, and a version starts wherever
the hash of the attributes differs from the one before. Hot entities are cut into slices (see slices).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.operators import dedupe
from harborline.operators.slices import sliced


def snake(c: Column) -> Column:
    """Field names of either case style in snake case."""
    return F.transform(c, lambda x: F.lower(F.regexp_replace(F.trim(x), "([a-z0-9])([A-Z])", "$1_$2")))


def is_set(fields: str, name: str) -> Column:
    """Whether an update sets a field: it names it, or, having no list, has a value for it."""
    return F.when(F.col(fields).isNull(), F.col(name).isNotNull()).otherwise(F.array_contains(snake(F.col(fields)), F.lit(name)))


def updates(df: DataFrame, entity: str, attributes: list[str], fields: str = "updated_fields", event_id: str = "event_id", row_id: str = "update_id") -> DataFrame:
    """Updates as (entity, at, _ord, _created, attributes as struct<v> where set): copies of an event count once, at the earliest arrival.

    Rows without an entity or a time can't be placed and are left out; rows without an identifier are no copies.
    """
    keyed = dedupe.keyed(df.withColumn("_type", F.lit("")), "_type", event_id, "ingest_time", row_id)
    cols = [F.col(entity).alias("entity"), F.col("event_time").alias("at"), "_key", "_ord", *[F.when(is_set(fields, a), F.struct(F.col(a).alias("v"))).alias(a) for a in attributes]]
    rows = keyed.select(*cols)
    return dedupe.first_rows(rows, "entity", "at", "_ord", *attributes).where("entity IS NOT NULL AND at IS NOT NULL")


def snapshots(df: DataFrame, entity: str, attributes: list[str]) -> DataFrame:
    """Full rows (as of a table of entities) in the form of updates(); they create their entity."""
    cols = [F.struct(F.col(a).alias("v")).alias(a) for a in attributes]
    full = df.select(F.col(entity).alias("entity"), F.col("event_time").alias("at"), F.lit(-1).cast("decimal(38,0)").alias("_ord"), *cols, F.struct(F.lit(True).alias("v")).alias("_created"))
    return full.where("entity IS NOT NULL AND at IS NOT NULL")


def versions(changes: DataFrame, attributes: list[str], created_by_any: bool = False) -> DataFrame:
    """(entity, attributes, valid_from, valid_to, is_current), one row per version.

    changes: the form of updates(), with `_created` set by rows that create an entity; what precedes the creation counts
    for nothing. created_by_any: the first row creates the entity. valid_to is exclusive, null for the current version.
    Rows equal in time apply by `_ord` and give one version. An empty input gives no rows.
    """
    every = [*attributes, "_created"]
    if created_by_any:
        changes = changes.withColumn("_created", F.struct(F.lit(True).alias("v")))
    last = [F.max_by(F.when(F.col(a).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col("_ord"))).alias(a) for a in every]
    states = sliced(changes.groupBy("entity", "at").agg(*last), ["entity"], ["at"], "states")

    ends = states.groupBy("entity", "_slice").agg(*[F.max_by(a, F.when(F.col(a).isNotNull(), F.col("at"))).alias(a) for a in every])
    before = Window.partitionBy("entity").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("entity", "_slice", *[F.last(a, ignorenulls=True).over(before).alias(f"_in_{a}") for a in every])
    running = Window.partitionBy("entity", "_slice").orderBy("at")
    digest = lambda prefix: F.when(F.col(f"{prefix}_created").isNotNull(), F.md5(F.to_json(F.struct(*[F.col(f"{prefix}{a}.v").alias(a) for a in attributes]), {"ignoreNullFields": "false"})))
    full = states.join(carried, ["entity", "_slice"])
    full = full.select("entity", "_slice", "at", *[F.coalesce(F.last(a, ignorenulls=True).over(running), F.col(f"_in_{a}")).alias(a) for a in every], digest("_in_").alias("_in_hash"))
    full = full.withColumn("_hash", digest("")).where("_hash IS NOT NULL")
    changed = ~F.col("_hash").eqNullSafe(F.coalesce(F.lag("_hash").over(running), F.col("_in_hash")))
    islands = full.withColumn("_island", F.sum(F.when(changed, 1).otherwise(0)).over(running)).where("_island > 0")
    starts = islands.groupBy("entity", "_slice", "_island").agg(F.min("at").alias("valid_from"), *[F.min_by(F.col(f"{a}.v"), "at").alias(a) for a in attributes])

    first = starts.groupBy("entity", "_slice").agg(F.min("valid_from").alias("_first"))
    after = Window.partitionBy("entity").orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
    nexts = first.select("entity", "_slice", F.min("_first").over(after).alias("_next"))
    ended = F.coalesce(F.lead("valid_from").over(Window.partitionBy("entity", "_slice").orderBy("valid_from")), F.col("_next"))
    out = starts.join(nexts, ["entity", "_slice"]).withColumn("valid_to", ended)
    return out.select("entity", *attributes, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def facility_history(facilities: DataFrame, facility_updates: DataFrame) -> DataFrame:
    """Every version of a facility's name, status and capacity; it starts with its row in facilities."""
    attributes = ["facility_name", "status", "capacity_units"]
    return versions(updates(facility_updates, "facility_id", attributes).unionByName(snapshots(facilities, "facility_id", attributes), allowMissingColumns=True), attributes)


def driver_history(driver_updates: DataFrame) -> DataFrame:
    """Every version of a driver's home facility; it starts with the first row."""
    return versions(updates(driver_updates, "driver_id", ["home_facility_id"]), ["home_facility_id"], created_by_any=True)

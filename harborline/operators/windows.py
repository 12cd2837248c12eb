"""Event-time windows, for batches and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(df: DataFrame, keys: list[str], seconds: int = 300, time: str = "event_time") -> DataFrame:
    """Counts per key and half-open window."""
    return _counted(df.groupBy(F.window(time, f"{seconds} seconds"), *keys), keys)


def sliding(df: DataFrame, keys: list[str], seconds: int = 300, every: int = 60, time: str = "event_time") -> DataFrame:
    """Counts per key and overlapping window; an event counts in seconds / every windows."""
    return _counted(df.groupBy(F.window(time, f"{seconds} seconds", f"{every} seconds"), *keys), keys)


def session(df: DataFrame, keys: list[str], gap: int = 300, time: str = "event_time") -> DataFrame:
    """Counts per key and session. Two events exactly one gap apart are two sessions, so the gap is cut by a microsecond."""
    return _counted(df.groupBy(F.session_window(time, f"{gap * 1_000_000 - 1} microseconds"), *keys), keys, "session_window", F.expr("INTERVAL 1 MICROSECOND"))


def _counted(grouped, keys: list[str], window: str = "window", more: Column | None = None) -> DataFrame:
    end = F.col(f"{window}.end") if more is None else F.col(f"{window}.end") + more
    return grouped.agg(F.count("*").alias("n")).select(*keys, F.col(f"{window}.start").alias("window_start"), end.alias("window_end"), "n")


def everlasting(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per key over all time."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def panes(deltas: DataFrame, watermark: Column, lateness_s: int = 86_400) -> DataFrame:
    """Per-batch window counts tagged as early, on_time or late (discarding panes: consumers sum them).

    watermark: reached with this batch; the column previous_watermark (null for the first batch) before it. Windows that
    ended more than the lateness before that are dropped.
    """
    before = F.coalesce(F.col("previous_watermark") < F.col("window_end"), F.lit(True))
    pane = F.when(watermark < F.col("window_end"), "early").when(before, "on_time").otherwise("late")
    open_ = F.coalesce(F.col("window_end") + F.make_dt_interval(secs=F.lit(lateness_s)) > F.col("previous_watermark"), F.lit(True))
    return deltas.where(open_).withColumn("pane", pane)

"""Counters and distributions observed on a plan as it runs, and a buffered client for metric points."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counted(df: DataFrame, name: str | Observation, **conditions: Column) -> DataFrame:
    """df that counts all rows and those that meet each condition while it runs; no extra pass."""
    return df.observe(name, F.count("*").alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()])


def distribution(df: DataFrame, name: str | Observation, column: str) -> DataFrame:
    """df that observes least, most, sum and count of a column while it runs."""
    return df.observe(name, F.min(column).alias("min"), F.max(column).alias("max"), F.sum(column).alias("sum"), F.count(column).alias("count"))


class Collector(StreamingQueryListener):
    """Sums the observed counters of streaming queries, by name and counter."""

    def __init__(self):
        self.totals: dict[tuple[str, str], float] = {}

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        for name, row in event.progress.observedMetrics.items():
            for k, v in row.asDict().items():
                if isinstance(v, (int, float)):
                    self.totals[name, k] = self.totals.get((name, k), 0) + v

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


@dataclass
class Metrics:
    """Buffers points and hands them to `send` in requests of at most `request` points; failures are counted, not raised."""

    send: Callable[[list[dict]], None]
    buffer: int = 100
    request: int = 200
    failed: int = 0
    _points: list[dict] = field(default_factory=list)

    def record(self, name: str, value: float, **labels: str) -> None:
        self._points.append({"name": name, "value": float(value), "timestamp": time.time(), "labels": labels})
        if len(self._points) >= self.buffer:
            self.flush()

    def increment(self, name: str, **labels: str) -> None:
        self.record(name, 1, **labels)

    gauge = record

    @contextmanager
    def timer(self, name: str, **labels: str):
        start = time.perf_counter()
        try:
            yield
        finally:
            self.record(f"{name}_ms", (time.perf_counter() - start) * 1000, **labels)

    def flush(self) -> None:
        points, self._points = self._points, []
        for k in range(0, len(points), self.request):
            try:
                self.send(points[k : k + self.request])
            except Exception:  # noqa: BLE001
                self.failed += 1

    close = flush

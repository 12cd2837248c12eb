"""Ordered scans per key that no hot key can hold up.

Rows are range-partitioned by (key, order), so that a key with very many rows is cut into slices of bounded size. Windows
run within (key, slice); what passes from slice to slice is one small row per (key, slice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.session import materialize, plan_bytes

SLICE_BYTES = 64 << 20
#: From here on an estimate stands for an unknown size.
UNKNOWN_BYTES = 1 << 50


def sliced(df: DataFrame, key: list[str], order: list[str], name: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """df with `_slice`, which grows with (key, order) and never parts rows that are equal in both; written once.

    The number of slices follows Catalyst's size estimate; a plan that it has no sensible one for is written and measured first.
    """
    if plan_bytes(df) >= UNKNOWN_BYTES:
        df = materialize(df, name)
    n = max(df.sparkSession.sparkContext.defaultParallelism, plan_bytes(df) // slice_bytes)
    return materialize(df.repartitionByRange(int(n), *key, *order).withColumn("_slice", F.spark_partition_id()), name)

"""Left lookup in a dimension that is broadcast only after a check of its size, and salted beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.session import materialize, plan_bytes

#: Largest written size of a dimension that is broadcast.
BROADCAST_BYTES = 8 << 20
#: Tasks that a hot key is spread over when the dimension is too large to broadcast.
SALTS = 32


def lookup(left: DataFrame, dim: DataFrame, key: str, spread: str, limit: int = BROADCAST_BYTES, salts: int = SALTS, written: bool = False) -> DataFrame:
    """left joined with dim, which has one row per key; rows without a match (or with a null key) get nulls.

    dim is written to the shared folder first, so that its true size is known (unless it is read from there: written). Up to `limit` bytes it is broadcast.
    Beyond that each of its rows is repeated for `salts` salts, and left is salted by a hash of the column `spread`, so
    that a hot key is spread over as many tasks; left isn't shuffled by the bare key in either case.
    """
    dim = dim.where(F.col(key).isNotNull())
    dim = dim if written else materialize(dim, "dimension")
    if plan_bytes(dim) <= limit:
        return left.join(F.broadcast(dim), key, "left")
    salted = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(salted, [key, "_salt"], "left").drop("_salt")

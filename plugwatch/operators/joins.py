"""Joins to a side with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str],
                how: str = "left") -> DataFrame:
    """Join ``left``, where a key may hold very many rows, to ``right`` with unique keys.

    Adaptive execution splits a hot key only if both sides are shuffled for the join. A right
    side that was just grouped by the keys would be used as it lies, and the hot key would be
    one task. Joining on a hash of the keys as well makes Spark shuffle it, without a change
    to the result. A right side measured as small is broadcast as ever.
    """
    types = {f.name: f.dataType for f in left.schema.fields}
    right = right.withColumns({k: F.col(f"`{k}`").cast(types[k]) for k in keys})
    mark = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    return left.withColumn("_hash", mark).join(
        right.withColumn("_hash", mark), [*keys, "_hash"], how).drop("_hash")

"""Floating-point sums in a fixed order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered_sum(df: DataFrame, keys: Sequence[str], value: str, order: str, alias: str = "total") -> DataFrame:
    """Sum doubles per key from the first to the last in ascending ``order``, so that every run gives the same bits.

    The sum is the plain left fold at any size. A fold is sequential by nature: a key's rows are sorted and streamed
    through one task, which can spill and holds none of them. For huge keys give the value an exact type
    (``decimal``, ``long``) and use ``sum``, which is split and combined map-side.
    """
    kept = df.where(F.col(value).isNotNull()).select(*keys, F.col(order).alias("_k"), F.col(value).alias("_x"))
    ahead = Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = kept.withColumn("_x", F.sum("_x").over(ahead))
    return running.groupBy(*keys).agg(F.max_by("_x", "_k").alias(alias))

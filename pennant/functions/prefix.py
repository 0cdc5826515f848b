"""Running sums without an ordered pass over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sums_before(df: DataFrame, by: Sequence[str], key: str, value: str, bits: Sequence[int]) -> DataFrame:
    """Add ``start``, the sum of ``value`` over the rows of the same ``by`` with a smaller ``key``, and ``total``, the
    sum over all of them. ``df`` is stored (it is read several times) and has distinct keys, ``key`` a long.

    No group is ordered as a whole: a directory holds the sums of the keys that agree but for their last ``bits``, the
    next directory the sums of those, and so on. A window sees 2**bits rows at most, and the last one the keys that are
    left after all shifts.
    """
    levels, here = [], df
    for b in bits:
        run = Window.partitionBy(*by, "_parent").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        here = here.withColumn("_parent", F.shiftright(key, b))
        here = here.withColumn("_before", F.coalesce(F.sum(value).over(run), F.lit(0)))
        levels.append(here)
        here = here.groupBy(*by, "_parent").agg(F.sum(value).alias(value)).withColumnRenamed("_parent", key)
    run = Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    above = here.select(
        *by, F.col(key).alias("_parent"), F.coalesce(F.sum(value).over(run), F.lit(0)).alias("start"),
        F.sum(value).over(Window.partitionBy(*by)).alias("total"),
    )
    for i, level in enumerate(reversed(levels)):
        own = [c for c in level.columns if c not in ("_parent", "_before")] if i == len(levels) - 1 else [*by, F.col(key).alias("_parent")]
        above = level.withColumnRenamed("_parent", "_up").join(above.withColumnRenamed("_parent", "_up"), [*by, "_up"]).select(
            *own, (F.col("_before") + F.col("start")).alias("start"), "total"
        )
    return above

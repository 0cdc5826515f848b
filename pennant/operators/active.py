"""Leaders among entities that are still active.

Active: the entity's last period is not before the last period of source 0 as a whole (all of its
lines, with or without a measure). Pass lines that keep null measures.

The last period of source 0 goes along with each entity's roll-up, which is written once: the lines are read in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.functions import asc_last, desc_last, ratio
from pennant.operators.leaders import top_n
from pennant.sources.checkpoints import cut_lineage


def _until() -> Column:
    return F.max(F.when(F.col("source") == 0, F.col("period"))).alias("until")


def _active(book: DataFrame) -> DataFrame:
    """Entities of a roll-up (last_period, until) that are active."""
    stored = cut_lineage(book)
    return stored.where(F.col("last_period") >= stored.agg(F.max("until")).scalar())


def _rounded(c, places: int | None):
    return c if places is None else F.round(c, places)


def active_total(lines: DataFrame, n: int, *, places: int | None = None) -> DataFrame:
    """Highest career totals. Names come from all lines, totals from measured ones."""
    measured = F.col("measure").isNotNull()
    book = (
        lines.groupBy("entity", "name")
        .agg(F.sum("measure").alias("total"), F.max(F.when(measured, F.col("period"))).alias("last_period"), _until())
        .groupBy("entity")
        .agg(*[F.max(c).alias(c) for c in ("name", "last_period", "until")], F.sum("total").alias("total"))
    )
    book = _active(book).withColumn("total", _rounded(F.col("total"), places))
    return top_n(book, [desc_last("total"), asc_last("entity")], n).select("entity", "name", "total")


def _counted(counts: Column) -> list[Column]:
    """Total and number of the lines that count, and the last period of source 0 among all."""
    return [F.sum(F.when(counts, F.col("measure"))).alias("total"), F.count(F.when(counts, 1)).alias("n"), _until()]


def _seen(c: str | Column) -> Column:
    """A value of a group in which some line counts."""
    return F.when(F.col("n") > 0, F.col(c) if isinstance(c, str) else c)


def active_average(
    lines: DataFrame, min_periods: int, n: int, *, leagues: Sequence[str] | None = None, places: int | None = None
) -> DataFrame:
    """Highest average season, at least ``min_periods`` seasons."""
    counts = F.col("measure").isNotNull()
    if leagues is not None:
        counts = counts & F.coalesce(F.col("league").isin(list(leagues)), F.lit(False))
    book = (
        lines.groupBy("entity", "name", "period")
        .agg(*_counted(counts))
        .groupBy("entity")
        .agg(
            F.max(_seen("name")).alias("name"), F.sum("total").alias("total"), F.max(_seen("period")).alias("last_period"),
            F.size(F.collect_set(_seen("period"))).cast("long").alias("periods"), F.max("until").alias("until"),
        )
    )
    book = _active(book).where(F.col("periods") >= min_periods).withColumn("average", _rounded(ratio("total", "periods"), places))
    return top_n(book, [desc_last("average"), asc_last("entity")], n).select(
        "entity", "name", "periods", "average", "total"
    )


def active_low_total(
    lines: DataFrame, min_periods: int, n: int, *, count_per_source: bool = True, places: int | None = None
) -> DataFrame:
    """Lowest career totals, at least ``min_periods`` seasons.

    ``count_per_source`` counts a season once per source it appears in; otherwise once.
    """
    season = F.struct("source", "period") if count_per_source else F.col("period")
    book = (
        lines.groupBy("entity", "name", "period", "source")
        .agg(*_counted(F.col("measure").isNotNull()))
        .groupBy("entity")
        .agg(
            F.max(_seen("name")).alias("name"), F.sum("total").alias("total"), F.max(_seen("period")).alias("last_period"),
            F.size(F.collect_set(_seen(season))).cast("long").alias("periods"), F.max("until").alias("until"),
        )
    )
    book = _active(book).where(F.col("periods") >= min_periods).withColumn("total", _rounded(F.col("total"), places))
    return top_n(book, [asc_last("total"), asc_last("entity")], n).select(
        "entity", "name", "periods", "total", "last_period"
    )


def active_low_average(
    lines: DataFrame, min_periods: int, n: int, *, pair_lines: bool = False, places: int | None = None
) -> DataFrame:
    """Lowest average season among entities of source 0, adding their source 1 lines of those seasons.

    By default every line counts once. With ``pair_lines`` each line of source 0 is paired with each
    line of source 1 of the same season before summing, as a plain join of the two would do; that is
    worked out from counts and sums per season, and no pairs are built.
    """
    first, second = F.col("source") == 0, F.col("source") == 1
    measured = F.col("measure").isNotNull()
    per_season = (
        lines.groupBy("entity", "name", "period")
        .agg(
            F.count(F.when(first & measured, 1)).alias("n0"),
            F.sum(F.when(first, F.col("measure"))).alias("s0"),
            F.count(F.when(second, 1)).alias("n1"),
            F.sum(F.when(second, F.col("measure"))).alias("s1"),
            _until(),
        )
        .groupBy("entity", "period")
        .agg(
            F.max(F.when(F.col("n0") > 0, F.col("name"))).alias("name"),
            F.sum("n0").alias("n0"), F.coalesce(F.sum("s0"), F.lit(0)).alias("s0"),
            F.sum("n1").alias("n1"), F.coalesce(F.sum("s1"), F.lit(0)).alias("s1"), F.max("until").alias("until"),
        )
        .withColumn("n", F.col("n0"))
    )
    if pair_lines:
        total = F.col("s0") * F.greatest("n1", F.lit(1)) + F.col("s1") * F.col("n0")
    else:
        total = F.col("s0") + F.col("s1")
    book = (
        per_season.groupBy("entity")
        .agg(
            F.max("name").alias("name"), F.count(_seen("period")).alias("periods"), F.sum(_seen(total)).alias("total"),
            F.max(_seen("period")).alias("last_period"), F.max("until").alias("until"),
        )
    )
    book = _active(book).where(F.col("periods") >= min_periods)
    book = book.withColumn("average", _rounded(ratio("total", "periods"), places))
    if places is not None:
        book = book.withColumn("total", F.round("total", places))
    return top_n(book, [asc_last("average"), asc_last("entity")], n).select(
        "entity", "name", "periods", "average", "total"
    )

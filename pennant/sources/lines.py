"""The normalised fact frame: one row per (entity, period, group) line of one source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# source number * 2^60 + line number: every line of source 0 comes before every line of source 1
SOURCE_BITS = 60
MAX_SOURCES = 8


@dataclass(frozen=True)
class Roles:
    """Which column of a table plays which part."""

    entity: str
    name: str
    period: str
    group: str
    league: str | None
    measure: str
    cost: str | None = None
    category: str | None = None
    line_no: str = "line_no"


def _exact(c: Column, kind: str) -> Column:
    """``c`` in an exact type; a value that would lose digits or does not fit is an error."""
    held = c.try_cast(kind)
    kept = c.isNull() | held.cast("double").eqNullSafe(c.cast("double"))
    lost = F.concat(F.lit(f"measure is no {kind}: "), c.cast("string"))
    return F.when(kept, held).otherwise(F.raise_error(lost).cast(kind))


def as_lines(
    df: DataFrame,
    roles: Roles,
    source: int | Column = 0,
    *,
    leagues: Sequence[str] | None = None,
    keep_null_measure: bool = False,
    flag: bool = False,
    measure_type: str | None = None,
    fold_group: str | None = "upper",
    where: Column | None = None,
) -> DataFrame:
    """Rename a source's columns to their roles, and keep the lines that count.

    ``measure_type`` should be an exact type (``long``, ``decimal(12,4)``): then every sum is the same
    in any order and can be combined map-side; a measure that it cannot hold stops the job. ``source`` is below
    ``MAX_SOURCES``. ``where`` is a user filter on the source's own columns. ``flag`` keeps all lines, and says in
    ``counted`` which ones the league and measure rules would keep.
    """
    if isinstance(source, int) and not 0 <= source < MAX_SOURCES:
        raise ValueError(f"source must be from 0 to {MAX_SOURCES - 1}")
    if where is not None:
        df = df.where(where)
    counts = F.lit(True)
    if leagues is not None:
        counts = F.coalesce(F.col(roles.league).isin(list(leagues)), F.lit(False))
    if not keep_null_measure:
        counts = counts & F.col(roles.measure).isNotNull()
    if not flag:
        df = df.where(counts)
    group = F.col(roles.group)
    if fold_group is not None:
        group = {"upper": F.upper, "lower": F.lower}[fold_group](group)
    measure = F.col(roles.measure)
    if measure_type is not None:
        measure = _exact(measure, measure_type)
    if not isinstance(source, int):
        known = source.isNull() | source.between(0, MAX_SOURCES - 1)
        source = F.when(known, source).otherwise(F.raise_error(F.lit(f"source must be from 0 to {MAX_SOURCES - 1}")).cast("int"))
    return df.select(
        F.col(roles.entity).alias("entity"),
        F.col(roles.name).alias("name"),
        F.col(roles.period).cast("int").alias("period"),
        group.alias("grp"),
        (F.col(roles.league) if roles.league else F.lit(None).cast("string")).alias("league"),
        (F.lit(source) if isinstance(source, int) else source).cast("int").alias("source"),
        F.col(roles.line_no).cast("long").alias("line_no"),
        measure.alias("measure"),
        (F.coalesce(F.col(roles.cost).cast("long"), F.lit(0)) if roles.cost else F.lit(0)).cast("long").alias("cost"),
        (F.col(roles.category) if roles.category else F.lit(None).cast("string")).alias("category"),
        *([counts.alias("counted")] if flag else []),
    )


def union_lines(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def line_order() -> Column:
    """Order of a line over all sources, one source after the other."""
    return F.shiftleft(F.col("source").cast("long"), SOURCE_BITS) + F.col("line_no")


def line_slot() -> Column:
    """Order of a line over all sources, interleaved by position in the own source."""
    return F.col("line_no") * MAX_SOURCES + F.col("source")


def lines_from_csv(df: DataFrame, measure: str, league: str, leagues: Sequence[str], season_type: str) -> DataFrame:
    """Raw lines with lower-case headers, a constant season type, and only the lines that count."""
    lower = df.toDF(*[c.lower() for c in df.columns]).withColumn("season_type", F.lit(season_type))
    return lower.where(F.col(measure.lower()).isNotNull() & F.col(league.lower()).isin(list(leagues)))


def last_period(lines: DataFrame, source: int | None = 0) -> DataFrame:
    """One row: the last period of one source (all lines, whatever their measure)."""
    own = lines if source is None else lines.where(F.col("source") == source)
    return own.agg(F.max("period"))


def active_since(lines: DataFrame, source: int | None = 0) -> Column:
    """Scalar: the last period of one source (all lines, whatever their measure)."""
    return last_period(lines, source).scalar()

"""Group (team) views: careers of a group's members, rosters, and roster strength."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import asc_last, desc_last, rounded_units
from pennant.operators.leaders import CAREER, SEASON, shown, top_n
from pennant.operators.ranking import numbered
from pennant.operators.rollups import careers, group_totals, season_groups, seasons
from pennant.operators.slots import slotted


def group_career_leaders(
    lines: DataFrame, group: str, n: int | None = None, *, worst: bool = False, group_order: str = "slot",
    places: int | None = None,
) -> DataFrame:
    """Careers of everyone who was ever in ``group``, best or worst first, sorted as printed with ``places``."""
    lines, group_order = slotted(lines, group_order)
    book = careers(seasons(lines, by_entity=True), group_order=group_order)
    book = book.where(F.array_contains("group_list", group))
    total = shown("total", places)
    first = asc_last(total) if worst else desc_last(total)
    return top_n(book, [first, asc_last("first_line")], n).select(*CAREER)


def rosters(lines: DataFrame) -> DataFrame:
    """(group, period) with the sum of its members' career totals.

    The order columns are plain longs, so the aggregation stays a hash aggregation.
    """
    return group_totals(lines).groupBy("period", "grp").agg(
        F.sum("career_total").alias("total"),
        F.count(F.lit(1)).alias("members"),
        F.min("entity_line").alias("entity_line"),
        F.min_by("first_line", "entity_line").alias("member_line"),
        F.min("first_line").alias("first_line"),
    )


def best_rosters(
    lines: DataFrame, n: int, *, by: str = "rounded", unit: int = 1, ranked: bool = False
) -> DataFrame:
    """Strongest rosters. ``by`` sorts on the ``rounded`` total or on the ``exact`` one."""
    found = rosters(lines).withColumn("rounded", rounded_units("total", unit))
    orders = [desc_last("rounded" if by == "rounded" else "total"), asc_last("entity_line"), asc_last("member_line")]
    best = top_n(found, orders, n)
    if ranked:
        # at most n rows from here on
        best = best.withColumn("rank", F.row_number().over(Window.orderBy(*orders))).orderBy("rank")
        best = best.withColumn("rank_label", F.concat(F.col("rank").cast("string"), F.lit(":")))
    return best.select(*(["rank_label"] if ranked else []), "period", "grp", "rounded")


def best_roster_per_group(lines: DataFrame, *, unit: int = 1, ranked: bool = False) -> DataFrame:
    """Each group's strongest roster, strongest group first."""
    orders = [desc_last("total"), asc_last("first_line")]
    place = F.row_number().over(Window.partitionBy("grp").orderBy(*orders))
    best = rosters(lines).withColumn("_place", place).where(F.col("_place") == 1)
    if ranked:
        best = numbered(best, orders).withColumn("rank_label", F.concat(F.col("rank").cast("string"), F.lit(":")))
    return best.orderBy(*orders).select(
        *(["rank_label"] if ranked else []), "period", "grp", rounded_units("total", unit).alias("rounded")
    )


def roster_careers(
    lines: DataFrame, group: str, period: int, *, concise: bool = False, unit: int = 1,
    places: int | None = None, group_order: str = "slot",
) -> DataFrame:
    """Careers of the members of one (group, period) roster, sorted as printed with ``places``."""
    lines, group_order = slotted(lines, group_order)
    here = F.bool_or((F.col("period") == period) & F.exists("sightings", lambda s: s["grp"] == group))
    book = careers(
        seasons(lines, by_entity=True), name_order="period", group_order=group_order, extra={"on_roster": here}
    ).where("on_roster")
    book = book.orderBy(desc_last(shown("total", places)), asc_last("name"), asc_last("entity"))
    if concise:
        return book.select("entity", "name", rounded_units("total", unit).alias("rounded"))
    return book.select(*CAREER)


def roster_period(lines: DataFrame, group: str, period: int, *, tie: str = "career") -> DataFrame:
    """Season totals, over all groups, of one roster's members.

    ``tie``: equal totals follow the entity's first line ever (``career``) or in this period (``period``).
    The ``period`` form reads only that period's lines.
    """
    if tie == "period":
        per_season = seasons(lines.where(F.col("period") == period)).withColumn("_tie", F.col("first_line"))
    else:
        per_season = seasons(lines, by_entity=True).withColumn(
            "_tie", F.min("first_line").over(Window.partitionBy("entity"))
        )
        per_season = per_season.where(F.col("period") == period)
    on_roster = F.exists("sightings", lambda s: s["grp"] == group)
    return (
        season_groups(per_season.where(on_roster)).orderBy(desc_last("total"), asc_last("_tie")).select(*SEASON)
    )

"""What a career or season cost against what it was worth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import asc_last, desc_last, ratio
from pennant.operators.leaders import top_n
from pennant.operators.rollups import careers, season_groups, seasons
from pennant.sources.checkpoints import cut_lineage
from pennant.sources.lines import active_since, last_period

CAREER_COST = ["entity", "name", "total", "cost", "periods", "span", "groups"]
SEASON_COST = ["entity", "name", "total", "cost", "period", "groups"]


def _book(lines: DataFrame, level: str) -> tuple[DataFrame, list[str]]:
    """Careers or seasons and their columns. Careers of flagged lines are those of active entities only.

    Flagged lines (all lines, see ``rollups.stints``) carry the last period of source 0 through the roll-up, so that the
    last period of all and the careers come from one pass over the lines; the careers are written once and read twice.
    """
    if level == "career" and "counted" in lines.columns:
        book = cut_lineage(careers(seasons(lines, by_entity=True)))
        latest = book.agg(F.max("active_until")).scalar()
        return book.where(F.col("n_lines") > 0).withColumn("active", F.col("last_period") >= latest), CAREER_COST
    if level == "career":
        return careers(seasons(lines, by_entity=True)), CAREER_COST
    if level == "period":
        return season_groups(seasons(lines)), SEASON_COST
    raise ValueError(f"unknown level {level!r}")


def _now(one: DataFrame) -> Column:
    """The value of a global aggregate, worked out at once."""
    return F.lit(one.first()[0]).cast(one.schema[0].dataType)


def cost_per_value(
    lines: DataFrame, n: int, *, level: str = "career", active_in: DataFrame | None = None, zero_base: str = "last"
) -> DataFrame:
    """Highest cost per point above the lowest total of all.

    The lowest row itself has a zero base; ``zero_base`` ranks it ``last`` or ``first``.
    Active entities alone are kept, those whose last period is that of source 0 as a whole, if ``lines`` are flagged
    (all lines of the table, one pass), or if ``active_in`` gives all lines beside stored stints.
    """
    book, columns = _book(lines, level)
    # the minimum and the ranking both read it: written once, so the lines are rolled up once
    if "active" not in book.columns:
        book = cut_lineage(book)
    lowest = _now(book.agg(F.min("total")))
    paid = book.where(F.col("cost") > 0)
    if "active" in book.columns:
        paid = paid.where("active")
    if active_in is not None:
        paid = paid.where(F.col("last_period") >= _now(last_period(active_in)))
    price = ratio("cost", F.col("total") - lowest)
    order = desc_last(price) if zero_base == "last" else price.desc_nulls_first()
    return top_n(paid, [order, asc_last("first_line")], n).select(*columns)


def costly_negative(lines: DataFrame, n: int) -> DataFrame:
    """Highest career cost among negative career totals."""
    book, columns = _book(lines, "career")
    return top_n(book.where(F.col("total") < 0), [desc_last("cost"), asc_last("first_line")], n).select(*columns)


def costly_periods(lines: DataFrame, n: int, group: str | None = None) -> DataFrame:
    """Highest-cost seasons, of all entities or of those in ``group`` that season."""
    per_season = seasons(lines)
    if group is not None:
        per_season = per_season.where(F.exists("sightings", lambda s: s["grp"] == group))
    return top_n(season_groups(per_season), [desc_last("cost"), asc_last("first_line")], n).select(*SEASON_COST)


def value_per_cost(
    lines: DataFrame, n: int, *, level: str = "career", since: int | None = None, active_in: DataFrame | None = None
) -> DataFrame:
    """Highest total per cost. ``since``: careers that lasted into that period, or seasons from it on.

    The name shown is that of the entity's first line ever, at both levels. Active entities: as in ``cost_per_value``.
    """
    if level == "career":
        book, columns = _book(lines, level)
        last = "last_period"
    else:
        per_season = seasons(lines, by_entity=True).withColumn(
            "name", F.min_by("name", "first_line").over(Window.partitionBy("entity"))
        )
        book, columns, last = season_groups(per_season), SEASON_COST, "period"
    book = book.where(F.col("cost") > 0)
    if "active" in book.columns:
        book = book.where("active")
    if since is not None:
        book = book.where(F.col(last) >= since)
    if active_in is not None:
        book = book.where(F.col(last) >= active_since(active_in))
    return top_n(book, [desc_last(ratio("total", "cost")), asc_last("first_line")], n).select(*columns)

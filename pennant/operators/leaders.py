"""Leaderboards, single-entity logs and name search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.functions import asc_last, desc_last, joined, ratio
from pennant.operators.rollups import careers, season_groups, seasons
from pennant.operators.slots import slotted

CAREER = ["entity", "name", "total", "periods", "span", "groups"]
SEASON = ["entity", "name", "total", "period", "groups"]


def top_n(df: DataFrame, orders: list[Column], n: int | None = None) -> DataFrame:
    """Sort, and keep the first ``n`` if given (a bounded heap per task, no full sort)."""
    ordered = df.orderBy(*orders)
    return ordered if n is None else ordered.limit(n)


def shown(column: str, places: int | None) -> Column:
    """What a report sorts by: a total as it is printed, so that equal prints fall back to the tie order."""
    return F.col(column) if places is None else F.round(column, places)


def career_leaders(
    lines: DataFrame, n: int, *, name_order: str = "period", group_order: str = "slot", season_filter: Column | None = None,
    places: int | None = None,
) -> DataFrame:
    """Entities with the highest career total, sorted as printed with ``places``.

    ``season_filter`` drops seasons before the roll-up. The group order ``kept`` is ``slot`` by the position among the
    given lines instead of the position in the file.
    """
    lines, group_order = slotted(lines, group_order)
    per_season = seasons(lines, by_entity=True)
    if season_filter is not None:
        per_season = per_season.where(season_filter)
    book = careers(per_season, name_order=name_order, group_order=group_order)
    return top_n(book, [desc_last(shown("total", places)), asc_last("name"), asc_last("entity")], n).select(*CAREER)


def period_leaders(lines: DataFrame, n: int, *, worst: bool = False) -> DataFrame:
    """Best or worst single seasons."""
    first = asc_last("total") if worst else desc_last("total")
    return top_n(season_groups(seasons(lines)), [first, asc_last("first_line")], n).select(*SEASON)


def entity_log(lines: DataFrame, entity: object) -> DataFrame:
    """All seasons of one entity, in line order. The filter reaches the scan."""
    own = lines.where(F.col("entity") == F.lit(entity))
    return season_groups(seasons(own)).orderBy(asc_last("first_line")).select(*SEASON)


def average_leaders(lines: DataFrame) -> DataFrame:
    """Every entity, best average season first."""
    book = careers(seasons(lines, by_entity=True), group_order="season")
    book = book.withColumn("average", ratio("total", "periods"))
    return book.orderBy(desc_last("average"), asc_last("first_line")).select(
        "entity", "name", "average", "total", "periods", "span", "groups"
    )


def search_names(lines: DataFrame, pattern: str, *, places: int | None = None) -> DataFrame:
    """Careers whose first name matches a LIKE pattern, ignoring case.

    The first name of a career is known only once its lines are rolled up, so careers are built, in one pass,
    and then filtered.
    """
    book = careers(seasons(lines, by_entity=True)).where(F.lower("name").like(pattern.lower()))
    return book.orderBy(desc_last(shown("total", places)), asc_last("first_line")).select(*CAREER)


def measure_leaders(lines: DataFrame, n: int, *, level: str = "career", places: int | None = None) -> DataFrame:
    """Leaders of one source's measure. ``career``: totals per (entity, name). ``line``: single lines."""
    if level == "line":
        best = top_n(lines, [desc_last("measure"), asc_last("source"), asc_last("line_no")], n)
        return best.select("entity", "name", "period", "grp", "league", "category", "measure")
    total = F.sum("measure")
    book = lines.groupBy("entity", "name").agg((F.round(total, places) if places is not None else total).alias("total"))
    return top_n(book, [desc_last("total"), asc_last("entity"), asc_last("name")], n)


def season_categories(lines: DataFrame) -> DataFrame:
    """(entity, period) totals with the greatest name and category string, in two steps.

    The strings are grouping keys first, so that the pass over the lines aggregates by hash.
    """
    return (
        lines.groupBy("entity", "name", "period", "category")
        .agg(F.sum("measure").alias("total"))
        .groupBy("entity", "period")
        .agg(F.max("name").alias("name"), F.max("category").alias("category"), F.sum("total").alias("total"))
    )


def average_measure(
    lines: DataFrame, min_periods: int, n: int, *, worst: bool = False, places: int | None = None
) -> DataFrame:
    """Best or worst average per season, at least ``min_periods`` seasons.

    The best form skips seasons without a category and lists the categories; the worst form keeps all
    seasons, groups by name too, and shows the greatest category.
    """
    per_season = season_categories(lines)
    if worst:
        book = per_season.groupBy("entity", "name").agg(
            F.count(F.lit(1)).alias("periods"), F.sum("total").alias("total"), F.max("category").alias("categories")
        )
    else:
        book = (
            per_season.where(F.col("category").isNotNull())
            .groupBy("entity")
            .agg(
                F.max("name").alias("name"),
                F.count(F.lit(1)).alias("periods"),
                F.sum("total").alias("total"),
                joined(F.array_sort(F.collect_set("category")), ", ").alias("categories"),
            )
        )
    average = ratio("total", "periods")
    book = book.where(F.col("periods") >= min_periods).withColumn(
        "average", F.round(average, places) if places is not None else average
    )
    first = asc_last("average") if worst else desc_last("average")
    return top_n(book, [first, asc_last("entity"), asc_last("name")], n).select(
        "entity", "name", "periods", "average", "total", "categories"
    )

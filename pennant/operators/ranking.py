"""Per-entity rankings: best seasons, peaks against careers, categories, ranks over a whole frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import asc_last, desc_last, first_item, first_seen, joined, list_position, ratio, year_span
from pennant.operators.leaders import CAREER, season_categories, shown, top_n
from pennant.operators.rollups import careers, seasons
from pennant.sources.checkpoints import cut_lineage


def top_per_group(df: DataFrame, keys: Sequence[str], orders: Sequence[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows per key. Spark trims every partition to ``k`` per key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*orders))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def top_ties(df: DataFrame, keys: Sequence[str], orders: Sequence[Column]) -> DataFrame:
    """All rows that share the first place per key."""
    place = F.rank().over(Window.partitionBy(*keys).orderBy(*orders))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def numbered(df: DataFrame, orders: Sequence[Column], alias: str = "rank", keys: Sequence[str] = ()) -> DataFrame:
    """Dense 1-based position of every row in a total order, overall or per key, however large.

    A window over all rows would put them in one task. Here rows are range-partitioned, the cut is
    written to the checkpoint folder, and each partition's rows are numbered on their own from the
    counts of the partitions before it. Only those counts, one row per partition, meet in one task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(n, *[asc_last(k) for k in keys], *orders)
    parts = cut_lineage(cut.withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.groupBy(*keys, "_part")
        .count()
        .select(*keys, "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    local = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*orders))
    return (
        parts.withColumn("_local", local)
        .join(starts, [*keys, "_part"])
        .withColumn(alias, (F.col("_start") + F.col("_local")).cast("long"))
        .drop("_part", "_local", "_start")
    )


def best_k_periods(lines: DataFrame, k: int, n: int, *, since: int | None = None, places: int | None = None) -> DataFrame:
    """Highest sum of an entity's ``k`` best seasons, sorted as printed with ``places``; groups come from those only.

    ``since``: only entities whose last season is in that period or later (all their seasons count).
    """
    whole = Window.partitionBy("entity")
    book = seasons(lines, by_entity=True).withColumns(
        {
            "entity_name": F.min_by("name", "first_line").over(whole),
            "entity_line": F.min("first_line").over(whole),
            "last_period": F.max("period").over(whole),
        }
    )
    if since is not None:
        book = book.where(F.col("last_period") >= since)
    chosen = top_per_group(book, ["entity"], [desc_last("total"), asc_last("first_line")], k)
    seen = F.flatten(F.collect_list("sightings"))
    totals = chosen.groupBy("entity").agg(
        F.first("entity_name").alias("name"),
        F.sum("total").alias("total"),
        F.count(F.lit(1)).alias("periods"),
        year_span(F.min("period"), F.max("period")).alias("span"),
        joined(first_seen(seen, "grp")).alias("groups"),
        F.min("entity_line").alias("first_line"),
    )
    return top_n(totals, [desc_last(shown("total", places)), asc_last("first_line")], n).select(*CAREER)


def _peak() -> Column:
    """Best season of an entity (ties: the earlier line), as an aggregate struct."""
    return F.max(F.struct(F.col("total").alias("total"), (-F.col("first_line")).alias("_l"), F.col("period").alias("period")))


def peak_under_cap(lines: DataFrame, cap: object, n: int, *, show: str = "peak") -> DataFrame:
    """Best single seasons among careers below ``cap``; an entity can appear more than once.

    ``show``: print the entity's ``peak`` season, or the ``selected`` season itself.
    """
    season = F.struct("total", "first_line", "period")
    book = careers(
        seasons(lines, by_entity=True), extra={"peak": _peak(), "log": F.collect_list(season)}
    ).where(F.col("total") < cap)
    best = top_n(
        book.withColumn("season", F.explode("log")), [desc_last("season.total"), asc_last("season.first_line")], n
    )
    shown = "peak" if show == "peak" else "season"
    return best.select(
        "entity", "name", "total", F.col(f"{shown}.total").alias("peak_total"),
        F.col(f"{shown}.period").alias("peak_period"), "periods", "span", "groups",
    )


def low_peak_over_floor(lines: DataFrame, floor: object, n: int, *, tie: Sequence[str] = ("first_line",)) -> DataFrame:
    """Lowest best season among careers above ``floor``. ``tie`` names the columns that break ties:
    ``first_line``, ``entity`` or ``peak_period``."""
    book = careers(seasons(lines, by_entity=True), extra={"peak": _peak()}).where(F.col("total") > floor)
    book = book.withColumn("peak_total", F.col("peak.total")).withColumn("peak_period", F.col("peak.period"))
    last = [] if {"first_line", "entity"} & set(tie) else ["entity"]
    return top_n(book, [asc_last("peak_total"), *[asc_last(t) for t in (*tie, *last)]], n).select(
        "entity", "name", "total", "peak_total", "peak_period", "periods", "span", "groups"
    )


def long_low_average(lines: DataFrame, min_periods: int, max_average: float) -> DataFrame:
    """Long careers with a low average season."""
    book = careers(seasons(lines, by_entity=True), group_order="season_then_line")
    low = (F.col("periods") >= min_periods) & (ratio("total", "periods") < max_average)
    return book.where(low).orderBy(asc_last("total"), asc_last("name"), asc_last("entity")).select(*CAREER)


def extreme_by_primary_category(
    lines: DataFrame, min_n: int, category_order: Sequence[str], *, places: int | None = None
) -> DataFrame:
    """Lowest career per primary category, among entities with ``min_n`` seasons in it; ties stay.

    The primary category of a season is the first of its list; that of an entity is the one with most
    seasons. The career total includes seasons without a category.
    """
    by_category = (
        lines.groupBy("entity", "name", "period", first_item("category").alias("category"))
        .agg(F.sum("measure").alias("total"))
        .repartition("entity")
        .groupBy("entity", "name", "category")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))
    )
    lead = F.min(F.when(F.col("category").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("category"))))
    book = (
        by_category.withColumn("lead", lead.over(Window.partitionBy("entity")))
        .where(F.col("lead.n") <= -min_n)
        .groupBy("entity", "name", "lead")
        .agg(F.sum("total").alias("total"))
        .select("entity", "name", F.col("lead.category").alias("category"), (-F.col("lead.n")).alias("periods"), "total")
    )
    lowest = top_ties(book, ["category"], [asc_last("total")])
    if places is not None:
        lowest = lowest.withColumn("total", F.round("total", places))
    return lowest.orderBy(list_position("category", category_order), "category", "entity", "name").select(
        "category", "entity", "name", "periods", "total"
    )


def extreme_average_by_category(
    lines: DataFrame, min_n: int, categories: Sequence[str], *, worst: bool = False, places: int | None = None
) -> DataFrame:
    """Best or worst average season per primary category, at least ``min_n`` seasons.

    Best: one category per season, from the season's greatest list; only the listed categories.
    Worst: a season counts once per category it was played in; all categories.
    """
    listed = lines.where(F.col("category").isNotNull())
    if worst:
        per_season = (
            listed.withColumn("category", F.split_part("category", F.lit(","), F.lit(1)))
            .where(F.col("category") != "")
            .groupBy("entity", "name", "period", "category")
            .agg(F.sum("measure").alias("total"))
            .groupBy("entity", "period", "category")
            .agg(F.max("name").alias("name"), F.sum("total").alias("total"))
        )
    else:
        per_season = season_categories(listed).withColumn("category", first_item("category"))
        per_season = per_season.where(F.col("category").isin(list(categories)))
    book = (
        per_season.groupBy("entity", "name", "category")
        .agg(F.count(F.lit(1)).alias("periods"), F.sum("total").alias("total"))
        .where(F.col("periods") >= min_n)
        .withColumn("average", ratio("total", "periods"))
    )
    first = asc_last("average") if worst else desc_last("average")
    best = top_per_group(book, ["category"], [first, asc_last("entity"), asc_last("name")])
    if places is not None:
        best = best.withColumn("average", F.round("average", places))
    order = [list_position("category", categories)] if worst else []
    return best.orderBy(*order, "category").select("category", "entity", "name", "periods", "average")

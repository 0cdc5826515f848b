"""Lines -> stints -> seasons -> careers: the roll-ups everything else is made of.

Shuffles. ``stints`` combines map-side on (entity, period, group) with fixed-width buffers only, so a
hot entity reaches the network as at most one row per period, group and map task. Everything that is
about whole entities then moves the (small) stints once, by entity, and stays in that partitioning:
seasons, careers, streaks and per-entity windows need no further exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import first_seen, joined, rounded_mean, year_span
from pennant.sources.bucketed import CLUSTERED
from pennant.sources.lines import line_order, line_slot


def stints(
    lines: DataFrame, *, name: bool = True, extra: tuple[str, ...] = (), also: dict[str, Column] | None = None
) -> DataFrame:
    """Totals per (entity, period, group).

    The name is a grouping key rather than an aggregate: string buffers would turn the hash
    aggregation over the raw lines into a sort. ``lines`` may be stored stints (``stored_stints``): they are added up.
    ``also`` are further aggregates. Lines with a ``counted`` column are all lines of a table: only counted ones enter
    the totals, and ``active_until`` is the last period of source 0 among all of them. Stints without a counted line stay,
    with ``n_lines`` 0, until a roll-up has passed that period on.
    """
    keys = ["entity", *(["name"] if name else []), "period", "grp", *extra]
    more = dict(also or {})
    flagged = "counted" in lines.columns
    if flagged:
        more["active_until"] = F.max(F.when(F.col("source") == 0, F.col("period")))
    others = [c.alias(k) for k, c in more.items()]
    if "n_lines" in lines.columns:
        sums = [F.sum(c).alias(c) for c in ("total", "cost", "n_lines")]
        return lines.groupBy(*keys).agg(*sums, *[F.min(c).alias(c) for c in ("first_line", "first_slot")], *others)

    def own(c: Column) -> Column:
        return F.when(F.col("counted"), c) if flagged else c

    return lines.groupBy(*keys).agg(
        F.sum(own(F.col("measure"))).alias("total"),
        F.sum(own(F.col("cost"))).alias("cost"),
        F.count(own(F.lit(1))).alias("n_lines"),
        F.min(own(line_order())).alias("first_line"),
        F.min(own(line_slot())).alias("first_slot"),
        *others,
    )


def stored_stints(lines: DataFrame) -> DataFrame:
    """Stints per source, to be written once and given to the operators in place of the lines.

    Everything that needs totals, costs, names, groups and their order gets the same result from them.
    """
    return stints(lines, extra=("source",))


def clustered(df: DataFrame) -> bool:
    """Whether the rows are read from a table that is bucketed by entity (see ``sources.bucketed``)."""
    return "entity" in df.columns and bool(df.schema["entity"].metadata.get(CLUSTERED))


def whole_entities(df: DataFrame) -> DataFrame:
    """All rows of an entity in one partition; stored tables are in that shape already."""
    return df if clustered(df) else df.repartition("entity")


def seasons(lines: DataFrame, *, by_entity: bool = False) -> DataFrame:
    """One row per (entity, period): name, total, mean cost, and where each group was first seen.

    ``by_entity`` keeps all seasons of an entity in one partition for the steps that follow.
    """
    per_stint = stints(lines)
    if by_entity and not clustered(lines):
        per_stint = per_stint.repartition("entity")
    flagged = "active_until" in per_stint.columns
    sighting = F.struct("first_line", "first_slot", "grp")
    return (
        per_stint.groupBy("entity", "period")
        .agg(
            F.min_by("name", "first_line").alias("name"),
            F.sum("total").alias("total"),
            F.sum("cost").alias("_cost"),
            F.sum("n_lines").alias("n_lines"),
            F.min("first_line").alias("first_line"),
            F.min("first_slot").alias("first_slot"),
            F.collect_list(F.when(F.col("n_lines") > 0, sighting) if flagged else sighting).alias("sightings"),
            *([F.max("active_until").alias("active_until")] if flagged else []),
        )
        .withColumn("cost", rounded_mean("_cost", "n_lines"))
        .drop("_cost")
    )


def _sightings_key(group_order: str) -> Column:
    """Re-key a season's sightings so that sorting them gives the wanted group order."""
    if group_order == "line":
        return F.transform("sightings", lambda s: F.struct(s["first_line"].alias("k"), s["grp"].alias("grp")))
    if group_order == "slot":
        return F.transform("sightings", lambda s: F.struct(s["first_slot"].alias("k"), s["grp"].alias("grp")))
    if group_order in ("season", "season_then_line"):
        return F.transform(
            "sightings",
            lambda s: F.struct(F.col("first_line").alias("s"), s["first_line"].alias("k"), s["grp"].alias("grp")),
        )
    raise ValueError(f"unknown group order {group_order!r}")


def careers(
    per_season: DataFrame, *, name_order: str = "line", group_order: str = "line", extra: dict[str, Column] | None = None
) -> DataFrame:
    """One row per entity. ``per_season`` should come from ``seasons(..., by_entity=True)``.

    ``name_order``: the name of the first ``line``, or of the first ``period``.
    ``group_order``: list groups by first ``line``; by ``slot`` (sources interleaved); by ``season``
    (earliest season, then line within it); or ``season_then_line`` (earliest season and earliest
    line taken separately). From flagged lines (see ``stints``) careers also have ``active_until`` and ``n_lines``.
    """
    flagged = "active_until" in per_season.columns
    extra = dict(extra or {}) | ({"active_until": F.max("active_until"), "n_lines": F.sum("n_lines")} if flagged else {})
    period = F.when(F.col("n_lines") > 0, F.col("period")) if flagged else F.col("period")
    out = (
        per_season.withColumn("_seen", _sightings_key(group_order))
        .groupBy("entity")
        .agg(
            F.min_by("name", F.col("first_line") if name_order == "line" else period).alias("name"),
            F.sum("total").alias("total"),
            F.sum("cost").alias("cost"),
            F.count(period).alias("periods"),
            F.min(period).alias("first_period"),
            F.max(period).alias("last_period"),
            F.min("first_line").alias("first_line"),
            F.flatten(F.collect_list("_seen")).alias("_seen"),
            *[c.alias(k) for k, c in extra.items()],
        )
    )
    if group_order == "season_then_line":
        groups = F.array_distinct(F.transform("_seen", lambda s: s["grp"]))

        def earliest(g: Column) -> Column:
            mine = F.filter("_seen", lambda s: s["grp"] == g)
            return F.struct(
                F.array_min(F.transform(mine, lambda s: s["s"])).alias("s"),
                F.array_min(F.transform(mine, lambda s: s["k"])).alias("k"),
                g.alias("grp"),
            )

        seen = F.transform(F.array_sort(F.transform(groups, earliest)), lambda s: s["grp"])
    else:
        seen = first_seen("_seen", "grp")
    return out.select(
        "entity", "name", "total", "cost", "periods", "first_period", "last_period", "first_line",
        year_span("first_period", "last_period").alias("span"),
        seen.alias("group_list"),
        joined(seen).alias("groups"),
        *extra,
    )


def season_groups(per_season: DataFrame) -> DataFrame:
    """Replace the sightings of a season by its comma-separated group list."""
    return per_season.withColumn("groups", joined(first_seen(_sightings_key("line"), "grp"))).drop("sightings")


def group_totals(lines: DataFrame) -> DataFrame:
    """(entity, period, group) memberships with the entity's career total and first line beside them."""
    per_entity = Window.partitionBy("entity")
    return whole_entities(stints(lines, name=False)).select(
        "entity", "period", "grp", "first_line",
        F.sum("total").over(per_entity).alias("career_total"),
        F.min("first_line").over(per_entity).alias("entity_line"),
    )


def totals_by_source(lines: DataFrame, keys: list[str], labels: dict[int, str]) -> DataFrame:
    """Total per key, and beside it the part that came from each source."""
    parts = [
        F.sum(F.when(F.col("source") == source, F.col("measure"))).alias(label) for source, label in labels.items()
    ]
    return lines.groupBy(*keys).agg(F.sum("measure").alias("total"), *parts)


def collections_by_entity(lines: DataFrame) -> DataFrame:
    """Set-valued season: the sorted distinct groups, leagues and sources of each (entity, period)."""
    return (
        stints(lines, name=False, extra=("league", "source"))
        .groupBy("entity", "period")
        .agg(
            F.sum("total").alias("total"),
            F.array_sort(F.collect_set("grp")).alias("group_set"),
            F.array_sort(F.collect_set("league")).alias("league_set"),
            F.array_sort(F.collect_set("source")).alias("source_set"),
        )
    )

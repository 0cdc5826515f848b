"""Cohort retention: who of a roster is still there some periods later."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import asc_last, desc_last, ratio, remap
from pennant.operators.leaders import SEASON
from pennant.operators.ranking import numbered, top_per_group
from pennant.operators.rollups import season_groups, seasons, stints, whole_entities


def _memberships(lines: DataFrame, gap: int, also: dict[str, Column] | None = None) -> DataFrame:
    """(entity, period, group) with the entity's season total, its first line, and ``retained``: whether the entity
    is in that group ``gap`` periods later.

    Everything is asked of frames over one order of the entity's rows, by period, so that they are sorted once: the groups
    of the period that lies ``gap`` ahead are a range frame, and there is no self join.
    """
    by_period = Window.partitionBy("entity").orderBy("period")
    ahead = F.collect_list(F.struct("grp")).over(by_period.rangeBetween(gap, gap))
    return whole_entities(stints(lines, name=False, also=also)).select(
        "entity", "period", "grp", *(also or {}),
        F.sum("total").over(by_period.rangeBetween(0, 0)).alias("season_total"),
        F.min("first_line").over(by_period.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("entity_line"),
        F.exists(ahead, lambda g: g["grp"].eqNullSafe(F.col("grp"))).alias("retained"),
    )


def top_of_rosters(lines: DataFrame, k: int, gap: int) -> DataFrame:
    """Top ``k`` members of every (group, period) by season total, each with ``retained``: whether
    the entity is in that group ``gap`` periods later.
    """
    return top_per_group(_memberships(lines, gap), ["grp", "period"], [desc_last("season_total"), asc_last("entity_line")], k)


def _retained_by_period(lines: DataFrame, k: int, gap: int, lo: int, hi: int) -> DataFrame:
    cohort = top_of_rosters(lines, k, gap).where(F.col("period").between(lo, hi - gap))
    return cohort.groupBy("grp", "period").agg(F.count(F.when(F.col("retained"), 1)).alias("retained"))


def retention(lines: DataFrame, group: str, k: int, gap: int, lo: int, hi: int) -> DataFrame:
    """Per period of one group: how many of its top ``k`` are members ``gap`` periods later."""
    per_period = _retained_by_period(lines, k, gap, lo, hi).where(F.col("grp") == group)
    return per_period.orderBy("period").select(
        F.col("period").alias("from_period"), (F.col("period") + gap).alias("to_period"), "retained"
    )


def average_retention(
    lines: DataFrame,
    k: int,
    gap: int,
    lo: int,
    hi: int,
    *,
    aliases: Mapping[str, str] | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Mean retained count per group, over its periods in ``lo..hi - gap``.

    Memberships follow renamed groups through ``aliases``. Whether a group spans ``lo..hi`` is asked of
    the codes as written in the data.
    """
    # One pass over the lines: a membership says whether its group has that code as written, and members are trimmed to k per
    # group, period and answer before they are moved. Those hold the k best of both, and a code as written is among them if any is.
    renamed = lines.withColumns({"_own": F.col("grp") == remap("grp", aliases or {}), "grp": remap("grp", aliases or {})})
    orders = [desc_last("season_total"), asc_last("entity_line")]
    trimmed = top_per_group(_memberships(renamed, gap, {"own": F.bool_or("_own")}), ["grp", "period", "own"], orders, k)
    place = F.row_number().over(Window.partitionBy("grp", "period").orderBy(*orders))
    per_period = trimmed.withColumn("place", place).groupBy("grp", "period").agg(
        F.count(F.when((F.col("place") <= k) & F.col("retained"), 1)).alias("retained"),
        F.max(F.when(F.col("own"), F.col("period"))).alias("own"),
    )
    cohort = F.col("period").between(lo, hi - gap)
    means = per_period.groupBy("grp").agg(
        ratio(F.sum(F.when(cohort, F.col("retained"))), F.count(F.when(cohort, 1))).alias("average_retained"),
        F.count(F.when(cohort, 1)).alias("n"), F.min("own").alias("first"), F.max("own").alias("last"),
    )
    eligible = (F.col("first") <= lo) & (F.col("last") >= hi) & ~F.col("grp").isin(list(exclude)) & (F.col("n") > 0)
    return means.where(eligible).orderBy(desc_last("average_retained"), asc_last("grp")).select("grp", "average_retained")


def _marked_seasons(lines: DataFrame, period: int, marks: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Seasons of ``period``, marked with the (group, period) rosters the entity is on."""
    periods = sorted({period, *[p for _, p in marks.values()]})
    per_season = seasons(lines.where(F.col("period").isin(periods)), by_entity=True)

    def on(group: str, at: int):
        return F.bool_or((F.col("period") == at) & F.exists("sightings", lambda s: s["grp"] == group)).over(
            Window.partitionBy("entity")
        )

    marked = per_season.withColumns({name: on(group, at) for name, (group, at) in marks.items()})
    return marked.where(F.col("period") == period)


def relative_retention(
    lines: DataFrame, source: str, period: int, kept_group: str, kept_period: int, target: str | None = None
) -> DataFrame:
    """Rank the ``source`` roster of ``period``; keep the ranks whose holders are in ``kept_group`` at
    ``kept_period``; show who holds those ranks on the ``target`` roster of the same period.

    Without a target the source roster itself is shown, which is simply its kept members.
    """
    marks = {"on_source": (source, period), "kept": (kept_group, kept_period)}
    if target is None:
        own = _marked_seasons(lines, period, marks).where(F.col("on_source") & F.col("kept"))
        return season_groups(own).orderBy(desc_last("total"), asc_last("name"), asc_last("entity")).select(*SEASON)
    marked = _marked_seasons(lines, period, {**marks, "on_target": (target, period)})
    # both rosters are numbered in one pass; between equal totals the target goes by entity first
    sides = F.array_compact(F.array(F.when(F.col("on_source"), F.lit("source")), F.when(F.col("on_target"), F.lit("target"))))
    members = season_groups(marked).withColumn("roster", F.explode(sides))
    tie = F.when(F.col("roster") == "target", F.col("entity"))
    orders = [desc_last("total"), asc_last("_tie"), asc_last("first_line")]
    ranked = numbered(
        members.select("roster", "kept", "entity", "name", "total", "period", "groups", "first_line", tie.alias("_tie")),
        orders,
        keys=["roster"],
    )
    kept_ranks = ranked.where((F.col("roster") == "source") & F.col("kept")).select("rank")
    shown = ranked.where(F.col("roster") == "target").join(kept_ranks, "rank", "left_semi")
    return shown.orderBy(desc_last("total"), asc_last("first_line")).select(*SEASON)

"""Award views: who was passed over, who won on little, what a selection was worth.

``awards`` has the columns entity, period, award, league, winner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import asc_last, desc_last, ratio
from pennant.operators.leaders import top_n
from pennant.sources.checkpoints import cut_lineage


def winners_of(awards: DataFrame, award: str, since: int | None = None) -> DataFrame:
    won = awards.where((F.col("award") == award) & F.col("winner"))
    return won if since is None else won.where(F.col("period") >= since)


def _season_shape(lines: DataFrame) -> DataFrame:
    """(entity, period): total and the greatest name, group and category, strings as keys first."""
    return (
        lines.groupBy("entity", "name", "period", "grp", "category")
        .agg(F.sum("measure").alias("total"))
        .groupBy("entity", "period")
        .agg(
            F.max("name").alias("name"), F.max("grp").alias("grp"), F.max("category").alias("category"),
            F.sum("total").alias("total"),
        )
    )


def award_snubs_anti(
    lines: DataFrame, awards: DataFrame, award: str, n: int, *, since: int | None = None,
    leagues: Sequence[str] | None = None,
) -> DataFrame:
    """Best seasons that did not win the award."""
    if since is not None:
        lines = lines.where(F.col("period") >= since)
    if leagues is not None:
        lines = lines.where(F.col("league").isin(list(leagues)))
    lost = _season_shape(lines).join(winners_of(awards, award), ["entity", "period"], "left_anti")
    return top_n(lost, [desc_last("total"), asc_last("entity"), asc_last("period")], n).select(
        "entity", "name", "period", "grp", "category", "total"
    )


def worst_winners(lines: DataFrame, awards: DataFrame, award: str, n: int) -> DataFrame:
    """Lowest seasons that won the award."""
    won = winners_of(awards, award).select("entity", "period").distinct()
    # seasons are unique after the roll-up, so no hot season can pile up in the join
    kept = _season_shape(lines).join(won, ["entity", "period"], "left_semi")
    return top_n(kept, [asc_last("total"), asc_last("entity"), asc_last("period")], n).select(
        "entity", "name", "period", "grp", "category", "total"
    )


def _ends(df: DataFrame, keys: Sequence[str], total: str, tie: str, n: int, places: int | None, *, top: bool) -> DataFrame:
    """The rows per key that can be part of a best-``n`` pair: the highest or lowest totals, two to spare.

    A pair of the best ``n`` holds one of the ``n + 1`` best contenders of its key (one may be the winner itself), for
    any other has ``n`` better ones, or equal ones that come first, and likewise on the winners' side. Where
    advantages are rounded, ties of the rounded value must stay: whole steps of the last place are ranked instead.
    Spark trims every task to these rows before anything moves.
    """
    first = desc_last if top else asc_last
    if places is None:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(first(total), asc_last(tie)))
    else:
        place = F.dense_rank().over(Window.partitionBy(*keys).orderBy(first(F.floor(F.col(total) * 10**places))))
    return df.withColumn("_place", place).where(F.col("_place") <= n + 3).drop("_place")


def award_snubs(
    lines: DataFrame,
    awards: DataFrame,
    award: str,
    n: int,
    *,
    since: int,
    leagues: Sequence[str],
    open_scope: str = "ML",
    places: int | None = None,
) -> DataFrame:
    """Seasons in one source that beat a winner of the award and did not win it.

    A winner stands for its own league, or for all if its league is ``open_scope``. The winner's total
    counts all its lines of the period, a rival's only those in one league. ``lines`` should keep
    lines without a measure, because names come from all lines.
    """
    won = winners_of(awards, award)
    measured = lines.where(F.col("measure").isNotNull())
    # totals per (entity, period, league) serve winners and rivals; written once, so that the lines are
    # read once and not once for each side
    by_league = cut_lineage(
        measured.groupBy("entity", "name", "period", "league")
        .agg(F.sum("measure").alias("total"))
        .groupBy("entity", "period", "league")
        .agg(F.max("name").alias("name"), F.sum("total").alias("total"))
    )
    season_totals = by_league.groupBy("entity", "period").agg(F.sum("total").alias("winner_total"))
    times = won.groupBy("entity", "period", F.col("league").alias("award_league")).agg(F.count(F.lit(1)).alias("_times"))
    winners = times.join(season_totals, ["entity", "period"]).select(
        F.col("entity").alias("winner"),
        "period",
        F.when(F.col("award_league").eqNullSafe(open_scope), None).otherwise(F.col("award_league")).alias("scope"),
        (F.col("winner_total") * F.col("_times")).alias("winner_total"),
    )
    contenders = by_league.where((F.col("period") >= since) & F.col("league").isin(list(leagues))).join(
        won, ["entity", "period"], "left_anti"
    )
    beats = (
        (F.col("scope").isNull() | (F.col("league") == F.col("scope")))
        & (F.col("entity") != F.col("winner"))
        & (F.col("total") > F.col("winner_total"))
    )
    rivals = _ends(contenders, ["period", "league"], "total", "entity", n, None, top=True)
    lowest = _ends(winners, ["period", "scope"], "winner_total", "winner", n, None, top=False)
    found = rivals.join(lowest, "period").where(beats).withColumn("advantage", F.col("total") - F.col("winner_total"))
    orders = [desc_last("advantage"), *[asc_last(c) for c in ("period", "entity", "league", "winner")]]
    best = cut_lineage(top_n(found, orders, n))
    # at most n winners are left; Spark sends them to the scan
    of_interest = best.select(F.col("winner").alias("entity")).distinct()
    names = (
        lines.select("entity", "name")
        .join(of_interest, "entity", "left_semi")
        .groupBy(F.col("entity").alias("winner"))
        .agg(F.max("name").alias("winner_name"))
    )
    best = best.join(names, "winner", "left")
    shown = {c: (F.round(c, places) if places is not None else F.col(c)) for c in ("total", "winner_total", "advantage")}
    return best.orderBy(*orders).select(
        "period", "league", "entity", "name", shown["total"].alias("total"), "winner", "winner_name",
        shown["winner_total"].alias("winner_total"), shown["advantage"].alias("advantage"),
    )


def award_snubs_two_source(
    lines: DataFrame,
    awards: DataFrame,
    award: str,
    n: int,
    *,
    since: int,
    leagues: Sequence[str],
    league_source: int = 0,
    places: int | None = None,
) -> DataFrame:
    """Seasons that beat the winner of their league, on the totals of both sources together.

    A season's league is the one with the highest total in ``league_source``; a name is taken from
    that source if it has one. Both sources' totals come out of one aggregation, so there is no full
    outer join.
    """
    recent = lines.where(F.col("period") >= since)
    own = F.col("source") == league_source
    by_league = (
        recent.groupBy("entity", "name", "period", "league", "source")
        .agg(F.sum("measure").alias("total"))
        .groupBy("entity", "period", "league")
        .agg(
            F.max(F.when(own, F.col("name"))).alias("own_name"),
            F.max(F.when(~own, F.col("name"))).alias("other_name"),
            F.sum("total").alias("total"),
            F.sum(F.when(own, F.col("total"))).alias("own_total"),
        )
    )
    counted = F.col("league").isin(list(leagues)) & F.col("own_total").isNotNull()
    lead = F.min(F.when(counted, F.struct((-F.col("own_total")).alias("t"), F.col("league").alias("league"))))
    # used on both sides below, so written once
    perf = cut_lineage(
        by_league.groupBy("entity", "period").agg(
            F.coalesce(F.max("own_name"), F.max("other_name")).alias("name"),
            F.sum("total").alias("total"),
            lead.alias("_lead"),
        )
    )
    won = winners_of(awards, award).select("entity", "period", "league")
    winners = won.join(perf, ["entity", "period"]).select(
        F.col("entity").alias("winner"), "period", "league", F.col("name").alias("winner_name"),
        F.col("total").alias("winner_total"),
    )
    rivals = perf.where(F.col("_lead").isNotNull()).withColumn("league", F.col("_lead.league")).drop("_lead")
    beats = (F.col("entity") != F.col("winner")) & (F.col("total") > F.col("winner_total"))
    best = _ends(rivals, ["period", "league"], "total", "entity", n, places, top=True)
    lowest = _ends(winners, ["period", "league"], "winner_total", "winner", n, places, top=False)
    found = best.join(lowest, ["period", "league"]).where(beats).withColumn("advantage", F.col("total") - F.col("winner_total"))
    if places is not None:
        found = found.withColumns({c: F.round(c, places) for c in ("total", "winner_total", "advantage")})
    orders = [desc_last("advantage"), *[asc_last(c) for c in ("period", "entity", "league", "winner")]]
    return top_n(found, orders, n).select(
        "period", "league", "entity", "name", "total", "winner", "winner_name", "winner_total", "advantage"
    )


def measure_per_award(
    lines: DataFrame, awards: DataFrame, award: str, n: int, *, since: int, places: int | None = None
) -> DataFrame:
    """Career total per time the award was won."""
    totals = (
        lines.where(F.col("period") >= since)
        .groupBy("entity", "name")
        .agg(F.sum("measure").alias("total"))
        .groupBy("entity")
        .agg(F.max("name").alias("name"), F.sum("total").alias("total"))
    )
    counts = winners_of(awards, award, since).groupBy("entity").agg(F.count(F.lit(1)).alias("times"))
    per = ratio("total", "times")
    book = totals.join(counts, "entity").withColumn("per_award", F.round(per, places) if places is not None else per)
    return top_n(book, [desc_last("per_award"), asc_last("entity")], n).select(
        "entity", "name", "total", "times", "per_award"
    )


def _group_award_average(shares: DataFrame, groups: DataFrame | None, places: int | None) -> DataFrame:
    """``shares``: (grp, period, times, amount) -> group averages over periods with more than one selection."""
    per_period = shares.groupBy("grp", "period").agg(F.sum("times").alias("times"), F.sum("amount").alias("amount"))
    book = (
        per_period.where(F.col("times") > 1)
        .groupBy("grp")
        .agg(F.sum("times").alias("times"), F.sum("amount").alias("amount"))
    )
    average = ratio("amount", "times")
    book = book.withColumn("average", F.round(average, places) if places is not None else average)
    label = F.upper("grp")
    if groups is not None:
        named = groups.select(F.upper("group_id").alias("_id"), "group_name")
        book = book.join(named, F.upper("grp") == F.col("_id"), "left")
        label = F.coalesce("group_name", label)
    return book.select(label.alias("group_name"), "times", "average").orderBy(asc_last("average"), asc_last("group_name"))


def group_award_average(
    lines: DataFrame,
    awards: DataFrame,
    award: str,
    *,
    since: int,
    groups: DataFrame | None = None,
    pair_sources: bool = False,
    places: int | None = None,
) -> DataFrame:
    """Per group: how often its members won the award, and their mean season total in those periods,
    counting only periods in which the group had more than one.

    By default a season counts once for each group it was played in, with its total there over both
    sources. With ``pair_sources`` every group line of source 0 is paired with every group line of
    source 1 of the same season, as an (entity, period) join of the two would do. That is worked out
    from counts and sums; no pairs are built.
    """
    won = winners_of(awards, award, since).groupBy("entity", "period").agg(F.count(F.lit(1)).alias("_won"))
    by_group = lines.groupBy("entity", "period", "grp", "source").agg(F.sum("measure").alias("total"))
    if not pair_sources:
        merged = by_group.groupBy("entity", "period", "grp").agg(F.sum("total").alias("total"))
        shares = merged.join(won, ["entity", "period"]).select(
            "grp", "period", F.col("_won").alias("times"), (F.col("total") * F.col("_won")).alias("amount")
        )
        return _group_award_average(shares, groups, places)
    season = Window.partitionBy("entity", "period")
    second = F.col("source") != 0
    n_first, n_second = F.count(F.when(~second, 1)).over(season), F.count(F.when(second, 1)).over(season)
    sum_second = F.coalesce(F.sum(F.when(second, F.col("total"))).over(season), F.lit(0))
    sized = by_group.select("*", n_first.alias("n0"), n_second.alias("n1"), sum_second.alias("sum1"))
    # a first-source group line stands for max(n1, 1) pairs; a second-source line only counts alone
    sized = sized.where(~second | (F.col("n0") == 0))
    pairs = F.when(second, F.lit(1)).otherwise(F.greatest("n1", F.lit(1)))
    amount = F.when(second, F.col("total")).otherwise(F.col("total") * pairs + F.col("sum1"))
    shares = sized.join(won, ["entity", "period"]).select(
        "grp", "period", (pairs * F.col("_won")).alias("times"), (amount * F.col("_won")).alias("amount")
    )
    return _group_award_average(shares, groups, places)

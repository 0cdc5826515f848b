"""Enrichment jobs: raw tables in, the tables the reports read out.

Every optional input may be ``None``: its columns are then left out and its join is not planned.
All side tables of a job are keyed by (lower-case entity, period) and merged first, so the lines are
moved and joined once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import joined, ratio
from pennant.sources.checkpoints import cut_lineage
from pennant.sources.files import crosswalk

# --- Fixed values -------------------------------------------------------------------------------

# Award names as the raw tables have them, and the short names used in reports.
PRIMARY_MVP = "Most Valuable Player"
SUBSTITUTE_MVP = "TSN Guide MVP"
MVP = "MVP"
PRIMARY_ROOKIE = "Rookie of the Year"
ROOKIE = "ROY"
SELECTION = "All-Star"

# Fielding codes kept as they are; PH and PR are not fielding positions.
FIELDING_CODES = {"P": "P", "C": "C", "1B": "1B", "2B": "2B", "3B": "3B", "SS": "SS", "OF": "OF"}
NOT_FIELDING = ("PH", "PR")

# Position numbers of the game logs.
POSITION_NUMBERS = {1: "P", 2: "C", 3: "1B", 4: "2B", 5: "3B", 6: "SS", 7: "LF", 8: "CF", 9: "RF", 10: "DH"}

# A position counts from 3 % of the season's games.
MIN_SHARE = Decimal("0.03")

BATTING_COUNTS = ["AB", "R", "H", "2B", "3B", "HR", "RBI", "SB", "CS", "BB", "SO", "HBP", "SF", "GIDP"]
PITCHING_COUNTS = [
    "W", "L", "GS", "CG", "SHO", "SV", "IPouts", "H", "ER", "HR", "BB", "SO", "WP", "HBP", "BK", "BFP",
]


@dataclass(frozen=True)
class LineKeys:
    """Key columns of a raw line table."""

    entity: str = "player_ID"
    period: str = "year_ID"
    stint: str = "stint_ID"
    league: str = "lg_ID"
    games: str = "G"
    starts: str = "GS"


@dataclass(frozen=True)
class PitcherRule:
    """Seasons in which a pitcher's batting line counts as a pitcher's position.

    Before ``first`` and after ``last`` everywhere; between them only in ``league``.
    """

    first: int = 1973
    last: int = 2022
    league: str = "NL"


# --- Awards -------------------------------------------------------------------------------------


def canonical_winners(awards: DataFrame, selections: DataFrame) -> DataFrame:
    """(entity, period, award, league) of every award won; selections may repeat.

    ``awards`` has entity, period, award, league; ``selections`` has entity, period, league. The
    substitute award stands for the primary one only where no primary was given in that period and
    league.
    """
    given = awards.where(F.col("award") == PRIMARY_MVP).select("period", "league").distinct().withColumn("_given", F.lit(True))
    tagged = awards.select("entity", "period", "award", "league").join(given, ["period", "league"], "left")
    kept = tagged.where((F.col("award") != SUBSTITUTE_MVP) | F.col("_given").isNull())
    short = (
        F.when(F.col("award").isin(PRIMARY_MVP, SUBSTITUTE_MVP), MVP)
        .when(F.col("award") == PRIMARY_ROOKIE, ROOKIE)
        .otherwise(F.col("award"))
    )
    won = kept.select("entity", "period", short.alias("award"), "league").distinct()
    return won.unionByName(selections.select("entity", "period", F.lit(SELECTION).alias("award"), "league"))


def build_awards(awards: DataFrame, shares: DataFrame, selections: DataFrame) -> DataFrame:
    """One row per award and candidate: every ballot, marked if won, and every win without a ballot."""
    won = cut_lineage(canonical_winners(awards, selections))
    ballots = shares.withColumn(
        "award", F.when(F.col("award") == PRIMARY_MVP, MVP).when(F.col("award") == PRIMARY_ROOKIE, ROOKIE).otherwise(F.col("award"))
    )

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"_key": F.lower("entity"), "_league": F.coalesce("league", F.lit(""))})

    winner_keys = keyed(won).select("_key", "period", "award", "_league").distinct().withColumn("_won", F.lit(True))
    voted = (
        keyed(ballots)
        .join(winner_keys, ["_key", "period", "award", "_league"], "left")
        .select(
            "entity", "period", "award", "league",
            F.coalesce("_won", F.lit(False)).alias("winner"),
            "points_won", "points_max", "votes_first",
            F.when(F.col("points_max") > 0, ratio("points_won", "points_max")).alias("vote_share"),
        )
    )
    balloted = keyed(ballots).select("_key", "period", "award").distinct()
    unvoted = (
        keyed(won)
        .join(balloted, ["_key", "period", "award"], "left_anti")
        .select("entity", "period", "award", "league", F.lit(True).alias("winner"))
    )
    return voted.unionByName(unvoted, allowMissingColumns=True)


def _repeated(entries: Column, field: str) -> Column:
    """Sorted (field, ..., copies) structs as a flat list with each field repeated ``copies`` times."""
    return F.flatten(F.transform(F.array_sort(entries), lambda e: F.array_repeat(e[field], e["copies"].cast("int"))))


def award_lists(awards: DataFrame, selections: DataFrame) -> DataFrame:
    """(entity, period) -> comma list of everything won, in name order; repeats stay.

    Every award row counts here, also when an entity has the same one twice.
    """
    given = awards.where(F.col("award") == PRIMARY_MVP).select("period", "league").distinct().withColumn("_given", F.lit(True))
    short = (
        F.when(F.col("award") == PRIMARY_MVP, MVP)
        .when((F.col("award") == SUBSTITUTE_MVP) & F.col("_given").isNull(), MVP)
        .when(F.col("award") == PRIMARY_ROOKIE, ROOKIE)
        .when(F.col("award") != SUBSTITUTE_MVP, F.col("award"))
    )
    named = awards.join(given, ["period", "league"], "left").select("entity", "period", short.alias("award"))
    every = named.unionByName(selections.select("entity", "period", F.lit(SELECTION).alias("award")))
    return (
        every.where(F.col("award").isNotNull())
        .groupBy("entity", "period", "award")
        .agg(F.count(F.lit(1)).cast("int").alias("copies"))
        .groupBy("entity", "period")
        .agg(joined(_repeated(F.collect_list(F.struct("award", "copies")), "award")).alias("awards"))
    )


def build_ballots(df: DataFrame, entity: str, period: str, votes: str, ballots: str, inducted: str, voted_by: str) -> DataFrame:
    """Ballot results with the vote percentage; text that is no number gives null."""
    v, b = F.col(votes).try_cast("int"), F.col(ballots).try_cast("int")
    return df.select(
        F.col(entity).alias("entity"),
        F.col(period).alias("period"),
        F.col(inducted).alias("inducted"),
        v.alias("votes"),
        b.alias("ballots"),
        F.when(b > 0, ratio(v * 100.0, b)).alias("vote_pct"),
        F.col(voted_by).alias("voted_by"),
    )


def build_groups(df: DataFrame, group_id: str, group_name: str, league: str) -> DataFrame:
    """The group dimension."""
    return df.select(
        F.col(group_id).alias("group_id"), F.col(group_name).alias("group_name"), F.col(league).alias("league")
    )


def build_crosswalk(df: DataFrame, from_column: str, to_column: str) -> DataFrame:
    """Id crosswalk; rows with a blank id are dropped."""
    return crosswalk(df, from_column, to_column)


# --- Category (position) lists ------------------------------------------------------------------


def share_filter(df: DataFrame, keys: Sequence[str], amount: str, min_share: Decimal = MIN_SHARE, copies: str | None = None) -> DataFrame:
    """Rows with at least ``min_share`` of their key's total. The comparison is exact.

    ``copies`` names a column that says how many equal rows a row stands for.
    """
    weight = F.col(amount) * F.col(copies) if copies else F.col(amount)
    total = F.sum(weight).over(Window.partitionBy(*keys))
    return df.withColumn("_total", total).where(F.col(amount) >= F.lit(min_share) * F.col("_total")).drop("_total")


def category_list(
    df: DataFrame,
    *,
    codes: Mapping[str, str] = FIELDING_CODES,
    skip: Sequence[str] = NOT_FIELDING,
    min_share: Decimal = MIN_SHARE,
) -> DataFrame:
    """(entity, period) -> comma list of codes by games, from stint rows (entity, period, code, games).

    Stints are not added up, so a code can repeat. Equal (code, games) rows are counted before they are
    moved, and a row needs ``min_share`` of the games, so no key keeps more than ``1 / min_share`` rows.
    """
    mapping = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    mapped = df.where(~F.col("code").isin(list(skip))).withColumn("code", mapping[F.col("code")])
    rows = (
        mapped.where(F.col("code").isNotNull())
        .groupBy("entity", "period", "code", "games")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    kept = share_filter(rows, ["entity", "period"], "games", min_share, copies="copies")
    entry = F.struct((-F.col("games")).alias("g"), F.col("code"), F.col("copies"))
    return kept.groupBy("entity", "period").agg(joined(_repeated(F.collect_list(entry), "code")).alias("categories"))


def category_list_from_events(
    df: DataFrame, *, numbers: Mapping[int, str] = POSITION_NUMBERS, min_share: Decimal = MIN_SHARE
) -> DataFrame:
    """(entity, period) -> comma list of positions by games, from one row (entity, period, code) a game.

    Codes outside ``numbers`` do not count. Equal counts follow the code.
    """
    counts = (
        df.where(F.col("code").isin(list(numbers)))
        .groupBy("entity", "period", "code")
        .agg(F.count(F.lit(1)).alias("games"))
    )
    mapping = F.create_map(*[F.lit(x) for kv in numbers.items() for x in kv])
    kept = share_filter(counts, ["entity", "period"], "games", min_share)
    entry = F.struct((-F.col("games")).alias("g"), F.col("code"))
    names = F.transform(F.array_sort(F.collect_list(entry)), lambda e: mapping[e["code"]])
    return kept.groupBy("entity", "period").agg(joined(names).alias("categories"))


def via_crosswalk(lists: DataFrame, links: DataFrame) -> DataFrame:
    """Re-key (entity, period, ...) rows through a (from_id, to_id) crosswalk."""
    return links.join(lists, links["from_id"] == lists["entity"]).select(
        F.col("to_id").alias("entity"), *[lists[c] for c in lists.columns if c != "entity"]
    )


# --- Counting stats and rates -------------------------------------------------------------------


def counting_totals(df: DataFrame, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Sums of whole-number text per key; text that is no number is left out, all-null sums stay null."""
    return df.groupBy(*keys).agg(*[F.sum(F.col(f"`{c}`").try_cast("int")).alias(c) for c in counts])


def batting_rates(totals: DataFrame) -> DataFrame:
    """AVG, OBP and SLG from season sums; null without a denominator or with a missing part."""
    ab, h, bb, hbp, sf = (F.col(c) for c in ("AB", "H", "BB", "HBP", "SF"))
    reached, chances = h + bb + hbp, ab + bb + hbp + sf
    bases = h + F.col("2B") + 2 * F.col("3B") + 3 * F.col("HR")
    return totals.withColumns(
        {
            "AVG": F.when(ab > 0, ratio(h, ab)),
            "OBP": F.when(chances > 0, ratio(reached, chances)),
            "SLG": F.when(ab > 0, ratio(bases, ab)),
        }
    )


def pitching_rates(totals: DataFrame) -> DataFrame:
    """IP from outs and ERA from IP."""
    outs = F.col("IPouts")
    innings = outs.cast("double") / 3.0
    return (
        totals.withColumns(
            {"IP": innings, "ERA": F.when(outs > 0, F.try_divide(F.col("ER").cast("double") * 9.0, innings))}
        )
        .withColumnRenamed("GS", "lh_GS")
        .drop("IPouts")
    )


# --- Line enrichment ----------------------------------------------------------------------------


def _side(df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Key an (entity, period, ...) table by lower-case entity."""
    rest = [F.col(f"`{c}`").alias((rename or {}).get(c, c)) for c in df.columns if c not in ("entity", "period")]
    return df.select(F.lower("entity").alias("_side_key"), F.col("period").alias("_side_period"), *rest)


def _merged(sides: Sequence[DataFrame]) -> DataFrame:
    """One table out of several that are keyed alike: per key one whole row of each.

    Ids that differ in case alone share a key. Of a side's rows of one key the greatest (column by column, from the
    first) stands for all; rows are never mixed. Sides come with one row per id, so nothing is gained by combining them
    before they are moved: the rows are moved first and sorted once.

    The lines then meet the table in one join. It is written out first: a join of two plain exchanges is the
    shape in which Spark splits a hot key at run time, which a chain of joins is not.
    """
    keys = ["_side_key", "_side_period"]
    values = [[c for c in side.columns if c not in keys] for side in sides]
    packed = [side.select(*keys, F.struct(*[f"`{c}`" for c in own]).alias(f"_side_{i}")) for i, (side, own) in enumerate(zip(sides, values))]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed)
    rows = stacked.repartition(*keys).groupBy(*keys).agg(*[F.max(f"_side_{i}").alias(f"_side_{i}") for i in range(len(sides))])
    return cut_lineage(rows.select(*keys, *[F.col(f"_side_{i}.`{c}`").alias(c) for i, own in enumerate(values) for c in own]))


def _attach(lines: DataFrame, sides: Sequence[DataFrame], keys: LineKeys, first_stint: Sequence[str] = ()) -> DataFrame:
    """Left join side tables by (lower-case entity, period); ``first_stint`` columns stay on stint 1 only."""
    if not sides:
        return lines
    side = _merged(sides)
    match = (F.lower(keys.entity) == F.col("_side_key")) & (F.col(keys.period) == F.col("_side_period"))
    on_first = F.col(keys.stint) == 1
    return (
        lines.join(side, match, "left")
        .withColumns({c: F.when(on_first, F.col(f"`{c}`")) for c in first_stint})
        .drop("_side_key", "_side_period")
    )


def _starter(games: Column, starts: Column) -> Column:
    return F.when(starts > games - starts, F.lit("SP")).otherwise(F.lit("RP"))


def attach_awards(lines: DataFrame, lists: DataFrame, keys: LineKeys = LineKeys()) -> DataFrame:
    """Add the award list of the season to its first stint."""
    return _attach(lines, [_side(lists)], keys, ["awards"])


def _values(*sides: DataFrame | None) -> list[str]:
    return [c for s in sides if s is not None for c in s.columns if c not in ("entity", "period")]


def enrich_a(
    lines: DataFrame,
    *,
    keys: LineKeys = LineKeys(),
    events: DataFrame | None = None,
    stints: DataFrame | None = None,
    pitchers: DataFrame | None = None,
    stats: DataFrame | None = None,
    awards: DataFrame | None = None,
    rule: PitcherRule = PitcherRule(),
) -> DataFrame:
    """Batting lines with position, counting stats, rates and awards.

    ``events`` and ``stints`` are category lists, ``stats`` season sums with rates, ``awards`` award
    lists; stats and awards go to the first stint. ``pitchers`` are raw pitching lines; they are added up
    per season first, so a batting line never repeats for a pitcher with several stints.
    """
    sides: list[DataFrame] = []
    sources: list[Column] = []
    if events is not None:
        sides.append(_side(events, {"categories": "positions_retro"}))
        sources.append(F.col("positions_retro"))
    if stints is not None:
        sides.append(_side(stints, {"categories": "positions_lahman"}))
        sources.append(F.col("positions_lahman"))
    sides += [_side(s) for s in (stats, awards) if s is not None]
    if pitchers is not None:
        totals = [F.sum(keys.games).alias("_games"), F.sum(keys.starts).alias("_starts"), F.lit(True).alias("_pitched")]
        season = [F.lower(keys.entity).alias("_side_key"), F.col(keys.period).alias("_side_period")]
        sides.append(pitchers.groupBy(*season).agg(*totals))
        year = F.col(keys.period)
        between = year.between(rule.first, rule.last) & (F.col(keys.league) == rule.league)
        counts = (year < rule.first) | (year > rule.last) | between
        sources.append(F.when(F.col("_pitched") & counts, _starter(F.col("_games"), F.col("_starts"))))
    out = _attach(lines, sides, keys, _values(stats, awards))
    if events is not None and stints is None:
        out = out.withColumn("positions_lahman", F.lit(None).cast("string"))
    if sources:
        out = out.withColumn("position", F.coalesce(*sources))
    return out.drop("_games", "_starts", "_pitched")


def enrich_b(
    lines: DataFrame,
    *,
    keys: LineKeys = LineKeys(),
    events: DataFrame | None = None,
    stats: DataFrame | None = None,
    awards: DataFrame | None = None,
) -> DataFrame:
    """Pitching lines with positions (starter or reliever where no list is known), stats and awards."""
    sides = [] if events is None else [_side(events, {"categories": "_listed"})]
    sides += [_side(s) for s in (stats, awards) if s is not None]
    out = _attach(lines, sides, keys, _values(stats, awards))
    if events is not None:
        role = _starter(F.col(keys.games), F.col(keys.starts))
        out = out.withColumn("positions", F.coalesce("_listed", role)).drop("_listed")
    return out

"""The baseball report catalog: every operator with the parameters of a published report."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.operators import active, awards, cohorts, groups, leaders, ranking, streaks, value
from pennant.operators.slots import kept_stints
from pennant.plans.reports import Field, Finished, Report, write_report
from pennant.sources import Roles, as_lines, read_bucketed, read_facts, union_lines

# --- Fixed values -------------------------------------------------------------------------------

MAJOR_LEAGUES = ("AL", "NL")
POSITIONS = ("C", "1B", "2B", "3B", "SS", "LF", "CF", "RF", "OF", "DH", "P")
FIELDERS = ("C", "1B", "2B", "3B", "SS", "LF", "CF", "RF", "OF", "DH")
# Clubs that moved, and the club whose code they share today; one club is left out of the averages.
MOVED_TEAMS = {"mon": "wsn", "ana": "laa", "ath": "oak"}
LEFT_OUT = ("laa",)
# First seasons of the modern era, the All-Star game, and the awards.
MODERN, ALL_STAR, MVP, CY_YOUNG, GOLD_GLOVE = 1947, 1933, 1922, 1956, 1957

# WAR is kept exact: its text has at most four decimals.
EXACT = "decimal(12,4)"

LEFT, RIGHT = "left", "right"
_RANK4, _RANK5 = Field("#", 4, RIGHT), Field("#", 5, RIGHT)
_NAME, _PLAYER = Field("name", 20, LEFT, "name"), Field("player", 22, LEFT, "player")
_WAR10 = Field("war", 10, RIGHT, "career_war")
_TAIL = (
    Field("seasons", 7, RIGHT, "season_count"), Field("", 11, LEFT, "year_range"), Field("teams", 256, LEFT, "teams"),
)
_YEAR, _TEAMS = Field("year", 4, RIGHT, "year"), Field("teams", 256, LEFT, "teams")
_SEASONS, _POSITION = Field("seasons", 7, RIGHT, "seasons"), Field("position", 10, LEFT, "position")
_CAREER_WAR = Field("career WAR", 10, RIGHT, "career_war")

CAREER = (_RANK5, _NAME, _WAR10, *_TAIL)
CAREER_COST = (_RANK5, _NAME, _WAR10, Field("salary", 10, RIGHT, "salary"), *_TAIL)
AVERAGE = (_RANK5, _NAME, Field("avg war", 10, RIGHT, "average_war"), _WAR10, *_TAIL)
PEAK = (_RANK5, _NAME, _WAR10, Field("peakwar", 12, RIGHT, "peak_war"), *_TAIL)
STREAK = (_RANK5, _NAME, *_TAIL)
SEASON = (_RANK5, _NAME, Field("war", 20, RIGHT, "war"), _YEAR, _TEAMS)
SEASON_COST = (_RANK5, _NAME, Field("war", 20, RIGHT, "war"), Field("salary", 10, RIGHT, "salary"), _YEAR, _TEAMS)
ROSTERS = (_RANK5, Field("year", 4, LEFT, "year"), Field("team", 4, RIGHT, "team"), Field("war", 4, RIGHT, "war"))
ROSTERS_CONCISE = tuple(Field(h, 0, LEFT, c) for h, c in (("#", "rank_label"), ("year", "year"), ("team", "team"), ("war", "war")))
ROSTER_CONCISE = (Field("#", 0, LEFT), Field("name", 0, LEFT, "name"), Field("war", 0, LEFT, "war"))
RETENTION = tuple(Field(str(i), 0, LEFT, c) for i, c in ((1, "from_year"), (2, "to_year"), (3, "retained")))
AVERAGE_RETENTION = (Field("team", 0, LEFT, "team"), Field("average years", 0, LEFT, "average_years"))
LOW_BY_POSITION = (_POSITION, _PLAYER, _SEASONS, _CAREER_WAR)
DEF_BY_POSITION = (_POSITION, _PLAYER, _SEASONS, Field("avg dWAR", 9, RIGHT, "average"))
WAR_BY_POSITION = (_POSITION, _PLAYER, _SEASONS, Field("avg WAR", 9, RIGHT, "average"))
DEF_CAREER = (_PLAYER, Field("career dWAR", 12, RIGHT, "career_dwar"))
DEF_SEASON = (
    _PLAYER, Field("year", 5, RIGHT, "year"), Field("team", 5, LEFT, "team"), Field("lg", 4, LEFT, "league"), _POSITION,
    Field("dWAR", 6, RIGHT, "dwar"),
)
DEF_AVERAGE_BEST = (
    _RANK4, _PLAYER, _SEASONS, Field("avg dWAR", 9, RIGHT, "average"), Field("career dWAR", 12, RIGHT, "career_dwar"),
    Field("positions", 20, LEFT, "positions"),
)
DEF_AVERAGE_WORST = (_RANK4, _PLAYER, _POSITION, _SEASONS, Field("avg dWAR", 9, RIGHT, "average"))
GOLD = (
    _RANK4, _PLAYER, Field("season", 6, RIGHT, "season"), Field("team", 6, LEFT, "team"), _POSITION, Field("dWAR", 6, RIGHT, "dwar"),
)
CY_SNUBS = (
    _RANK4, Field("season", 6, RIGHT, "season"), Field("lg", 4, LEFT, "league"), Field("snubbed pitcher", 22, LEFT, "player"),
    Field("war", 6, RIGHT, "war"), Field("cy young winner", 22, LEFT, "winner"), Field("winner war", 10, RIGHT, "winner_war"),
    Field("war adv", 8, RIGHT, "advantage"),
)
MVP_SNUBS = (
    _RANK4, Field("season", 6, RIGHT, "season"), Field("lg", 4, LEFT, "league"), Field("snubbed player", 22, LEFT, "player"),
    Field("war", 6, RIGHT, "war"), Field("mvp winner", 22, LEFT, "winner"), Field("mvp war", 8, RIGHT, "winner_war"),
    Field("war adv", 8, RIGHT, "advantage"),
)
PER_ALL_STAR = (
    _PLAYER, _CAREER_WAR, Field("all-stars", 9, RIGHT, "all_stars"), Field("WAR/all-star", 12, RIGHT, "per_all_star"),
)
TEAM_ALL_STARS = (
    Field("team", 28, LEFT, "team"), Field("all-stars", 9, RIGHT, "all_stars"),
    Field("avg WAR (all-star seasons)", 26, RIGHT, "average"),
)
ACTIVE_CAREER = (_PLAYER, _CAREER_WAR)
ACTIVE_AVERAGE = (_PLAYER, _SEASONS, Field("avg WAR", 9, RIGHT, "average"), _CAREER_WAR)
ACTIVE_LOW = (_PLAYER, _SEASONS, _CAREER_WAR, Field("last season", 11, RIGHT, "last_season"))

# --- Tables bound to roles ----------------------------------------------------------------------


@dataclass
class Book:
    """The enriched tables, and the line frames the reports ask for."""

    bat: DataFrame
    pitch: DataFrame
    awards_table: DataFrame | None = None
    teams_table: DataFrame | None = None
    stints_table: DataFrame | None = None  # the major leagues' lines, rolled up once for all reports

    @classmethod
    def open(cls, spark: SparkSession, folder: str, awards: bool = True, teams: bool = True, stints: bool = True) -> Book:
        """Tables as the table build writes them, under ``folder``; without ``stints`` reports roll the lines up."""

        def lines(name: str) -> DataFrame:
            df = spark.read.parquet(f"{folder}/{name}")
            return df if "line_no" in df.columns else read_facts(spark, f"{folder}/{name}")

        return cls(
            lines("war_daily_bat"),
            lines("war_daily_pitch"),
            spark.read.parquet(f"{folder}/awards") if awards else None,
            spark.read.parquet(f"{folder}/teams") if teams else None,
            read_bucketed(spark, f"{folder}/stints") if stints else None,
        )

    @cached_property
    def version(self) -> str:
        """Names the tables' files, which a table that is written anew does not share with the one before it."""
        tables = [t for t in (self.bat, self.pitch, self.awards_table, self.teams_table, self.stints_table) if t is not None]
        return hashlib.sha256("\n".join(f for t in tables for f in ["", *sorted(t.inputFiles())]).encode()).hexdigest()

    def roll_up(self) -> DataFrame:
        """The table of stints, with groups as written and slots by the position among these lines."""
        return kept_stints(union_lines(*[self._lines(s, leagues=MAJOR_LEAGUES, fold_group=None) for s in (0, 1)]))

    def _lines(self, source: int, measure: str = "WAR", **options) -> DataFrame:
        df = (self.bat, self.pitch)[source]
        have = {c.lower() for c in df.columns}
        category = ("position", "positions")[source]
        roles = Roles(
            "player_ID", "name_common", "year_ID", "team_ID", "lg_ID", measure,
            cost="salary" if "salary" in have else None,
            category=category if category in have else None,
        )
        return as_lines(df, roles, source, measure_type=EXACT, **options)

    @cached_property
    def lines(self) -> DataFrame:
        if self.stints_table is not None:
            return self.stints_table.withColumn("grp", F.upper("grp"))
        return self.major_lines

    @cached_property
    def major_lines(self) -> DataFrame:
        """Single lines of the major leagues, for what stints do not hold."""
        return union_lines(*[self._lines(s, leagues=MAJOR_LEAGUES) for s in (0, 1)])

    @cached_property
    def lower_lines(self) -> DataFrame:
        if self.stints_table is not None:
            return self.stints_table.withColumn("grp", F.lower("grp"))
        return union_lines(*[self._lines(s, leagues=MAJOR_LEAGUES, fold_group="lower") for s in (0, 1)])

    @cached_property
    def all_lines(self) -> DataFrame:
        return union_lines(*[self._lines(s, keep_null_measure=True) for s in (0, 1)])

    @cached_property
    def measured(self) -> DataFrame:
        return self.all_lines.where(F.col("measure").isNotNull())

    @cached_property
    def defence(self) -> DataFrame:
        return self._lines(0, "WAR_def")

    @cached_property
    def awards(self) -> DataFrame:
        return self.awards_table.select(
            F.col("player_ID").alias("entity"), F.col("year_ID").cast("int").alias("period"), "award",
            F.col("lg_ID").alias("league"), "winner",
        )

    @cached_property
    def teams(self) -> DataFrame:
        return self.teams_table.select(F.col("team_id").alias("group_id"), F.col("team_name").alias("group_name"))


def _war(c: str, places: int = 2) -> Column:
    return F.round(c, places).cast("double")


def _career(df: DataFrame) -> DataFrame:
    return df.select(
        "name", _war("total").alias("career_war"), F.col("periods").alias("season_count"), F.col("span").alias("year_range"),
        F.col("groups").alias("teams"), *[F.col(c).alias("salary") for c in df.columns if c == "cost"],
        *[_war(c).alias("average_war") for c in df.columns if c == "average"],
    )


def _season(df: DataFrame) -> DataFrame:
    cost = [F.col("cost").alias("salary")] if "cost" in df.columns else []
    return df.select("name", _war("total").alias("war"), F.col("period").alias("year"), F.col("groups").alias("teams"), *cost)


def _streak(df: DataFrame) -> DataFrame:
    return df.select(
        "name", F.col("periods").alias("season_count"), F.col("span").alias("year_range"), F.col("groups").alias("teams")
    )


def _peak(df: DataFrame) -> DataFrame:
    peak = F.concat(_war("peak_total").cast("string"), F.lit(" ("), F.col("peak_period").cast("string"), F.lit(")"))
    return df.select(
        "name", _war("total").alias("career_war"), peak.alias("peak_war"), F.col("periods").alias("season_count"),
        F.col("span").alias("year_range"), F.col("groups").alias("teams"),
    )


def _rosters(df: DataFrame) -> DataFrame:
    label = ["rank_label"] if "rank_label" in df.columns else []
    return df.select(*label, F.col("period").alias("year"), F.col("grp").alias("team"), F.col("rounded").alias("war"))


def _renamed(**columns: str | tuple[str, int]) -> Callable[[DataFrame], DataFrame]:
    """Select under new names; a (column, places) pair is rounded for print."""

    def shape(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col(c) if isinstance(c, str) else _war(*c)).alias(k) for k, c in columns.items()])

    return shape


_BY_POSITION = _renamed(position="category", player="name", seasons="periods", average="average")
_GOLD = _renamed(player="name", season="period", team="grp", position="category", dwar=("total", 1))
_SNUB = _renamed(
    season="period", league="league", player="name", war=("total", 1), winner="winner_name",
    winner_war=("winner_total", 1), advantage=("advantage", 1),
)


def _reports() -> Iterable[Report]:
    def add(name: str, title: str, layout, shape, build) -> Report:
        return Report(name, title, layout, lambda book: shape(build(book)))

    yield add("career_leaders", "Top 10 careers by WAR", CAREER, _career, lambda b: leaders.career_leaders(b.lines, 10, group_order="kept", places=2))
    yield add("season_leaders", "Top 10 seasons by WAR", SEASON, _season, lambda b: leaders.period_leaders(b.lines, 10))
    yield add(
        "season_trailers", "Bottom 10 seasons by WAR", SEASON, _season,
        lambda b: leaders.period_leaders(b.lines, 10, worst=True),
    )
    yield add("log_ruthba01", "Seasons of ruthba01", SEASON, _season, lambda b: leaders.entity_log(b.lines, "ruthba01"))
    yield add("average_leaders", "Careers by average season", AVERAGE, _career, lambda b: leaders.average_leaders(b.lines))

    for team in ("BOS", "NYY"):
        for worst in (False, True):
            yield add(
                f"team_{team.lower()}_{'worst' if worst else 'best'}_30",
                f"{'Bottom' if worst else 'Top'} 30 careers of {team} players", CAREER, _career,
                lambda b, t=team, w=worst: groups.group_career_leaders(b.lines, t, 30, worst=w, group_order="kept", places=2),
            )
    yield add(
        "team_bos_best", "Careers of BOS players, best first", CAREER, _career,
        lambda b: groups.group_career_leaders(b.lines, "BOS", group_order="kept", places=2),
    )
    yield add(
        "team_bos_worst", "Careers of BOS players, worst first", CAREER, _career,
        lambda b: groups.group_career_leaders(b.lines, "BOS", worst=True, group_order="season", places=2),
    )
    yield add(
        "best_rosters", "Top 1000 rosters by career WAR", ROSTERS, _rosters, lambda b: groups.best_rosters(b.lower_lines, 1000)
    )
    yield add(
        "best_rosters_concise", "Top 1000 rosters by career WAR, concise", ROSTERS_CONCISE, _rosters,
        lambda b: groups.best_rosters(b.lower_lines, 1000, by="exact", ranked=True),
    )
    yield add(
        "best_roster_per_team", "Best roster of each team", ROSTERS, _rosters,
        lambda b: groups.best_roster_per_group(b.lower_lines),
    )
    yield add(
        "best_roster_per_team_concise", "Best roster of each team, concise", ROSTERS_CONCISE, _rosters,
        lambda b: groups.best_roster_per_group(b.lower_lines, ranked=True),
    )
    for k in (3, 5, 7):
        for since in (None, MODERN):
            yield add(
                f"best_{k}_seasons" + (f"_since_{since}" if since else ""),
                f"Top 50 by best {k} seasons" + (f", careers reaching {since}" if since else ""), CAREER, _career,
                lambda b, k=k, s=since: ranking.best_k_periods(b.lines, k, 50, since=s, places=2),
            )
    for threshold in range(5, 15):
        yield add(
            f"streak_over_{threshold}", f"Top 50 runs of seasons over {threshold} WAR", STREAK, _streak,
            lambda b, t=threshold: streaks.longest_streak(b.lines, t, 50, keep_zero=t not in (8, 9)),
        )
    for cap in (10, 15, 20, 30):
        yield add(
            f"peak_under_{cap}", f"Top 20 seasons among careers under {cap} WAR", PEAK, _peak,
            lambda b, c=cap: ranking.peak_under_cap(b.lines, c, 20, show="selected" if c == 10 else "peak"),
        )
    for floor in range(40, 161, 10):
        tie = ("peak_period", "entity") if floor == 90 else ("first_line",) if 100 <= floor <= 150 else ("entity",)
        yield add(
            f"low_peak_over_{floor}", f"20 lowest best seasons among careers over {floor} WAR", PEAK, _peak,
            lambda b, f=floor, t=tie: ranking.low_peak_over_floor(b.lines, f, 20, tie=t),
        )
    yield add("costly_careers", "20 careers with most salary per WAR above the lowest", CAREER_COST, _career, lambda b: value.cost_per_value(b.lines, 20, zero_base="first"))
    yield add(
        "costly_careers_active", "20 active careers with most salary per WAR above the lowest", CAREER_COST, _career,
        lambda b: value.cost_per_value(b.lines, 20, active_in=b.all_lines, zero_base="first"),
    )
    yield add("costly_careers_negative", "20 best-paid careers with negative WAR", CAREER_COST, _career, lambda b: value.costly_negative(b.lines, 20))
    yield add("costly_seasons", "20 best-paid seasons", SEASON_COST, _season, lambda b: value.costly_periods(b.lines, 20))
    for team in ("BOS", "NYY"):
        yield add(
            f"costly_seasons_{team.lower()}", f"20 best-paid seasons of {team} players", SEASON_COST, _season,
            lambda b, t=team: value.costly_periods(b.lines, 20, t),
        )
    yield add(
        "costly_seasons_per_war", "20 seasons with most salary per WAR above the lowest", SEASON_COST, _season,
        lambda b: value.cost_per_value(b.lines, 20, level="period", zero_base="first"),
    )
    for level, layout, shape in (("career", CAREER_COST, _career), ("period", SEASON_COST, _season)):
        for since in (None, MODERN, 2000):
            yield add(
                f"value_{'careers' if level == 'career' else 'seasons'}" + (f"_since_{since}" if since else ""),
                f"20 {'careers' if level == 'career' else 'seasons'} with most WAR per salary" + (f", since {since}" if since else ""),
                layout, shape, lambda b, lv=level, s=since: value.value_per_cost(b.lines, 20, level=lv, since=s),
            )
    yield add(
        "value_careers_active", "20 active careers with most WAR per salary", CAREER_COST, _career,
        lambda b: value.value_per_cost(b.lines, 20, active_in=b.all_lines),
    )
    for name, pattern in (("contains_war", "%war%"), ("starts_babe", "babe %"), ("starts_cecil", "cecil %")):
        yield add(f"name_{name}", f"Careers by name: {pattern}", CAREER, _career, lambda b, p=pattern: leaders.search_names(b.lines, p, places=2))
    for year, team in ((1928, "PHA"), (1959, "MLN"), (1996, "CLE"), (2005, "NYY")):
        yield add(
            f"roster_{year}_{team.lower()}", f"Careers of the {year} {team} roster", CAREER, _career,
            lambda b, y=year, t=team: groups.roster_careers(b.lines, t, y, places=2, group_order="kept"),
        )
    for year, team in ((1928, "PHA"), (2005, "NYY")):
        yield add(
            f"roster_{year}_{team.lower()}_concise", f"Careers of the {year} {team} roster, concise", ROSTER_CONCISE,
            _renamed(name="name", war="rounded"), lambda b, y=year, t=team: groups.roster_careers(b.lines, t, y, concise=True, places=2, group_order="kept"),
        )
    for year in (2019, 2022):
        for team in ("BOS", "NYY", "OAK"):
            tie = "career" if year == 2019 and team != "OAK" else "period"
            yield add(
                f"season_{year}_{team.lower()}", f"{year} season of the {team} roster", SEASON, _season,
                lambda b, y=year, t=team, o=tie: groups.roster_period(b.lines, t, y, tie=o),
            )
    for team in ("bos", "oak"):
        yield add(
            f"retention_{team}", f"Top 5 of {team} still there after 3 years, 2000-2022", RETENTION,
            _renamed(from_year="from_period", to_year="to_period", retained="retained"),
            lambda b, t=team: cohorts.retention(b.lower_lines, t, 5, 3, 2000, 2022),
        )
    for k in (3, 5):
        yield add(
            f"average_retention_top_{k}", f"Top {k} still there after 3 years, 2000-2022, by team", AVERAGE_RETENTION,
            _renamed(team="grp", average_years="average_retained"),
            lambda b, k=k: cohorts.average_retention(b.lower_lines, k, 3, 2000, 2022, aliases=MOVED_TEAMS, exclude=LEFT_OUT),
        )
    for kept, target in ((2019, None), (2022, None), (2022, "BOS"), (2022, "NYY")):
        yield add(
            f"relative_retention_oak_{kept}_{(target or 'oak').lower()}",
            f"2019 {target or 'OAK'} at the ranks that OAK kept until {kept}", SEASON, _season,
            lambda b, k=kept, t=target: cohorts.relative_retention(b.lines, "OAK", 2019, "OAK", k, t),
        )
    yield add(
        "low_careers_by_position", "Lowest career per position, 10 seasons or more", LOW_BY_POSITION,
        _renamed(position="category", player="name", seasons="periods", career_war=("total", 1)),
        lambda b: ranking.extreme_by_primary_category(b.measured.where(F.col("source") == 0), 10, POSITIONS),
    )
    yield add(
        "long_low_careers", "10 seasons or more, under 0.5 WAR a season", CAREER, _career,
        lambda b: ranking.long_low_average(b.lines, 10, 0.5),
    )
    yield add(
        "defence_careers", "Top 10 careers by defensive WAR", DEF_CAREER, _renamed(player="name", career_dwar=("total", 1)),
        lambda b: leaders.measure_leaders(b.defence, 10, places=1),
    )
    yield add(
        "defence_seasons", "Top 10 season lines by defensive WAR", DEF_SEASON,
        _renamed(player="name", year="period", team="grp", league="league", position="category", dwar=("measure", 4)),
        lambda b: leaders.measure_leaders(b._lines(0, "WAR_def", fold_group=None), 10, level="line"),
    )
    yield add(
        "defence_average_best", "20 best average seasons by defensive WAR, 5 seasons or more", DEF_AVERAGE_BEST,
        _renamed(player="name", seasons="periods", average="average", career_dwar=("total", 1), positions="categories"),
        lambda b: leaders.average_measure(b.defence, 5, 20, places=3),
    )
    yield add(
        "defence_average_worst", "20 worst average seasons by defensive WAR, 5 seasons or more", DEF_AVERAGE_WORST,
        _renamed(player="name", position="categories", seasons="periods", average="average"),
        lambda b: leaders.average_measure(b.defence, 5, 20, worst=True, places=2),
    )
    yield add(
        "defence_best_by_position", "Best average defensive season per position, 10 seasons or more", DEF_BY_POSITION, _BY_POSITION,
        lambda b: ranking.extreme_average_by_category(b.defence, 10, FIELDERS, places=2),
    )
    yield add(
        "worst_by_position", "Worst average season per position, 10 seasons or more", WAR_BY_POSITION, _BY_POSITION,
        lambda b: ranking.extreme_average_by_category(b.measured, 10, POSITIONS, worst=True, places=2),
    )
    yield add(
        "gold_glove_snubs", "20 best defensive seasons without a Gold Glove", GOLD, _GOLD,
        lambda b: awards.award_snubs_anti(b.defence, b.awards, "Gold Glove", 20, since=GOLD_GLOVE, leagues=MAJOR_LEAGUES),
    )
    yield add(
        "gold_glove_worst", "20 worst defensive seasons with a Gold Glove", GOLD, _GOLD,
        lambda b: awards.worst_winners(b.defence, b.awards, "Gold Glove", 20),
    )
    yield add(
        "cy_young_snubs", "20 seasons that beat a Cy Young winner", CY_SNUBS, _SNUB,
        lambda b: awards.award_snubs(
            b.all_lines.where(F.col("source") == 1), b.awards, "Cy Young Award", 20, since=CY_YOUNG, leagues=MAJOR_LEAGUES
        ),
    )
    yield add(
        "mvp_snubs", "20 seasons that beat the MVP of their league", MVP_SNUBS, _SNUB,
        lambda b: awards.award_snubs_two_source(b.measured, b.awards, "MVP", 20, since=MVP, leagues=MAJOR_LEAGUES, places=1),
    )
    yield add(
        "war_per_all_star", "Top 50 careers by WAR per All-Star selection", PER_ALL_STAR,
        _renamed(player="name", career_war=("total", 1), all_stars="times", per_all_star="per_award"),
        lambda b: awards.measure_per_award(b.measured, b.awards, "All-Star", 50, since=ALL_STAR, places=2),
    )
    yield add(
        "team_all_stars", "Average WAR of each team's All-Star seasons", TEAM_ALL_STARS,
        _renamed(team="group_name", all_stars="times", average="average"),
        lambda b: awards.group_award_average(
            b.major_lines, b.awards, "All-Star", since=ALL_STAR, groups=b.teams, pair_sources=True, places=2
        ),
    )
    yield add(
        "active_careers_high", "20 highest careers of active players", ACTIVE_CAREER, _renamed(player="name", career_war=("total", 1)),
        lambda b: active.active_total(b.all_lines, 20, places=1),
    )
    yield add(
        "active_average_high", "20 highest average seasons of active players, 3 seasons or more", ACTIVE_AVERAGE,
        _renamed(player="name", seasons="periods", average="average", career_war=("total", 1)),
        lambda b: active.active_average(b.all_lines, 3, 20, leagues=MAJOR_LEAGUES, places=2),
    )
    yield add(
        "active_careers_low", "10 lowest careers of active players, 8 seasons or more", ACTIVE_LOW,
        _renamed(player="name", seasons="periods", career_war=("total", 1), last_season="last_period"),
        lambda b: active.active_low_total(b.all_lines, 8, 10, places=1),
    )
    yield add(
        "active_average_low", "10 lowest average seasons of active players, 8 seasons or more", ACTIVE_AVERAGE,
        _renamed(player="name", seasons="periods", average="average", career_war=("total", 2)),
        lambda b: active.active_low_average(b.all_lines, 8, 10, pair_lines=True, places=2),
    )


CATALOG: dict[str, Report] = {r.name: r for r in _reports()}


def run_report(book: Book, name: str) -> DataFrame:
    """The result set of one report, sorted."""
    return CATALOG[name].build(book)


def run_catalog(book: Book, out: str, names: Iterable[str] | None = None, resume: bool = False) -> list[str]:
    """Write every report (or the named ones) under ``out``; returns the names written.

    Each report that is whole is noted under ``out/_finished`` with the version of the tables it was made from. With
    ``resume`` those are skipped, so that a run goes on where one before it stopped; reports of other tables, or whose
    files are no longer whole, are written again.
    """
    spark = book.bat.sparkSession
    notes = Finished(spark, out, book.version)
    done = []
    for name in sorted(CATALOG) if names is None else names:
        if resume and notes.holds(name):
            continue
        notes.remove(name)
        write_report(run_report(book, name), CATALOG[name], out)
        notes.add(name)
        done.append(name)
    return done

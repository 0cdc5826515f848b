"""One query per deliverable: the operator on the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import files
from checks import tables as t
from pennant.functions import asc_last, desc_last, ordered_sum
from pennant.operators import active, awards, cohorts, enrich, groups, leaders, ranking, rollups, streaks, value
from pennant.plans.reports import Field, labelled, text_lines
from pennant.sources import as_lines, number_lines, union_lines, unpivot_slots

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that give non-trivial results on these tables (cents, minus LINE_OFFSET per line).
GROUP, OTHER_GROUP = "NATION_3", "NATION_11"
PERIOD, LATER = 1998, 2000
ENTITY = 137
ALIASES = {"NATION_1": "NATION_2", "NATION_7": "NATION_8", "NATION_12": "NATION_3"}
POSITIONS = ["C", "1B", "2B", "3B", "SS", "LF", "CF", "RF", "OF", "DH", "P"]
FIELDERS = POSITIONS[:-1]
RULE = enrich.PitcherRule(first=1997, last=1999, league="ASIA")


def _all(s, d):
    return t.lines(s, d, leagues=None)


def _thick(s, d):
    """Lines after filters that drop many more of one source than of the other, so that positions among them shift."""
    keep = (F.col("source") == 1) | (F.col("games") > 30)
    return t.lines(s, d, where=keep)


def career_seasons_best(s: SparkSession, d: str) -> DataFrame:
    return leaders.career_leaders(t.lines(s, d), 100)


def _opposite_sources(s: SparkSession, d: str) -> DataFrame:
    """Both sources read on their own, normalised and put together, totalled per period and source."""
    base = t.star(s, d).withColumn("category", F.lit(None).cast("string"))
    both = union_lines(
        *[as_lines(base.where(F.col("source") == k), t.ROLES, k, leagues=t.LEAGUES) for k in (0, 1)]
    )
    return both.groupBy("source", "period", "league").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("measure").alias("total"), F.count_distinct("entity").alias("entities")
    )


def _line_order(s: SparkSession, d: str) -> DataFrame:
    li = number_lines(t.table(s, d, "lineitem"))
    return li.where(F.col("l_quantity") > 10).groupBy("l_suppkey", "l_linestatus").agg(
        F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.count(F.lit(1)).alias("n_lines")
    )


def _slots(s: SparkSession, d: str) -> DataFrame:
    li = t.table(s, d, "lineitem").withColumn("period", F.year("l_shipdate"))
    blank = F.when(F.col("l_linenumber") == 3, F.lit("0")).otherwise(F.col("l_partkey").cast("string"))
    odd = F.when(F.col("l_linenumber") == 5, F.lit("x")).otherwise(F.col("l_linenumber").cast("string"))
    long = unpivot_slots(li, ["period"], [(blank, odd), (F.col("l_suppkey"), F.col("l_quantity").cast("int"))])
    return long.groupBy("period", "id", "code").agg(F.count(F.lit(1)).alias("n"))


def _ordered_sum(s: SparkSession, d: str) -> DataFrame:
    base = t.star(s, d).select("entity", "period", "amount", "line_no")
    return ordered_sum(base, ["entity", "period"], "amount", "line_no")


def _islands(s: SparkSession, d: str) -> DataFrame:
    book = rollups.seasons(t.lines(s, d), by_entity=True)
    tagged = streaks.islands(book, ["entity"], "first_line", F.col("total") > 5_000_000)
    runs = tagged.where(F.col("island").isNotNull()).groupBy("entity", "island")
    return runs.agg(
        F.count(F.lit(1)).alias("length"), F.sum("total").alias("total"), F.min("period").alias("lo"), F.max("period").alias("hi")
    ).drop("island")


def _category_events(s, d):
    return enrich.category_list_from_events(t.events(s, d))


def _share_filter(s, d):
    counts = t.events(s, d).groupBy("entity", "period", "code").agg(F.count(F.lit(1)).alias("games"))
    return enrich.share_filter(counts, ["entity", "period"], "games", min_share=enrich.Decimal("0.20"))


def _batting(s, d, base=None):
    return enrich.batting_rates(enrich.counting_totals(t.raw_batting(s, d, base), ["entity", "period"], enrich.BATTING_COUNTS))


def _pitching(s, d, base=None):
    return enrich.pitching_rates(enrich.counting_totals(t.raw_pitching(s, d, base), ["entity", "period"], enrich.PITCHING_COUNTS))


def _event_lists(s, d, base=None):
    """Category lists keyed by the register's first id, brought over to the second."""
    by_register = t.events(s, d, base).withColumn("entity", F.concat(F.lit("r"), F.col("entity")))
    lists = enrich.category_list_from_events(by_register)
    return enrich.via_crosswalk(lists, enrich.build_crosswalk(t.raw_register(s, d), "key_a", "key_b"))


def _award_lists(s, d, base=None):
    given, _, chosen = t.raw_awards(s, d, base)
    return enrich.award_lists(given, chosen)


def _j2(s, d):
    star = files.stored_star(s, d)
    return enrich.attach_awards(t.raw_lines(s, d, 0, star), _award_lists(s, d, star)).select(
        "line_no", "player_ID", "year_ID", "stint_ID", "awards"
    )


def _j3(s, d):
    orders = t.table(s, d, "orders").withColumns(
        {
            "votes": F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise((F.col("o_orderkey") % 97).cast("string")),
            "ballots": (F.col("o_custkey") % 50).cast("string"),
            "period": F.year("o_orderdate"),
        }
    )
    return enrich.build_ballots(orders, "o_orderkey", "period", "votes", "ballots", "o_orderstatus", "o_orderpriority")


def _j4(s, d):
    nation = t.table(s, d, "nation").join(t.table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return enrich.build_groups(nation, "n_nationkey", "n_name", "r_name")


def _j8(s, d):
    star = files.stored_star(s, d)
    rich = enrich.enrich_a(
        t.raw_lines(s, d, 0, star), events=_event_lists(s, d, star), stints=enrich.category_list(t.raw_fielding(s, d, star)),
        pitchers=t.raw_lines(s, d, 1, star), stats=_batting(s, d, star), awards=_award_lists(s, d, star), rule=RULE,
    )
    return rich.select(
        "line_no", "player_ID", "year_ID", "stint_ID", "positions_retro", "positions_lahman", "position",
        "AB", "H", "HR", "AVG", "OBP", "SLG", "awards",
    )


def _j9(s, d):
    star = files.stored_star(s, d)
    rich = enrich.enrich_b(
        t.raw_lines(s, d, 1, star), events=_event_lists(s, d, star), stats=_pitching(s, d, star), awards=_award_lists(s, d, star)
    )
    return rich.select(
        "line_no", "player_ID", "year_ID", "stint_ID", "positions", "W", "L", "lh_GS", "IP", "ER", "ERA", "BFP", "awards"
    )


def _groups_dim(s, d):
    dim = _j4(s, d).select(F.lower("group_name").alias("group_id"), F.initcap("group_name").alias("group_name"))
    return dim.where(F.col("group_name") != "Nation_5")


REPORT_LAYOUT = (
    Field("#", 5, "right"), Field("name", 20, "left", "name"), Field("total", 20, "right", "total"),
    Field("year", 4, "right", "period"), Field("groups", 256, "left", "groups"),
)


def _text_report(s, d):
    best = leaders.period_leaders(t.lines(s, d), 100)
    return text_lines(labelled(best, REPORT_LAYOUT), "Best seasons", REPORT_LAYOUT)


def _ranked_seasons(s, d):
    """Place of every season among all seasons."""
    book = rollups.season_groups(rollups.seasons(t.lines(s, d))).select("entity", "period", "total", "first_line")
    return ranking.numbered(book, [desc_last("total"), asc_last("first_line")]).drop("first_line")


def _top_three(s, d):
    book = rollups.season_groups(rollups.seasons(t.lines(s, d))).select("entity", "period", "total", "first_line")
    return ranking.top_per_group(book, ["period"], [desc_last("total"), asc_last("first_line")], 3).drop("first_line")


QUERIES: dict[str, Query] = {
    "t01_career_leaders": career_seasons_best,
    "t01_career_leaders_season_filter": lambda s, d: leaders.career_leaders(
        t.lines(s, d), 100, season_filter=(F.col("total") > 0) & (F.col("period") >= 1997)
    ),
    "t01_career_leaders_kept": lambda s, d: leaders.career_leaders(_thick(s, d), 500, group_order="kept"),
    "t01_career_leaders_places": lambda s, d: leaders.career_leaders(t.lines(s, d), 500, places=-7),
    "t02_period_leaders_top": lambda s, d: leaders.period_leaders(t.lines(s, d), 100),
    "t02_period_leaders_bottom": lambda s, d: leaders.period_leaders(t.lines(s, d), 100, worst=True),
    "t03_entity_log": lambda s, d: leaders.entity_log(t.lines(s, d), ENTITY),
    "t04_average_leaders": lambda s, d: leaders.average_leaders(t.lines(s, d)),
    "t05_group_best": lambda s, d: groups.group_career_leaders(t.lines(s, d), GROUP, 30),
    "t05_group_worst": lambda s, d: groups.group_career_leaders(t.lines(s, d), GROUP, worst=True, group_order="season"),
    "t05_group_best_kept": lambda s, d: groups.group_career_leaders(_thick(s, d), GROUP, group_order="kept"),
    "t05_group_worst_places": lambda s, d: groups.group_career_leaders(t.lines(s, d), GROUP, 200, worst=True, places=-7),
    "t06_best_rosters": lambda s, d: groups.best_rosters(t.lines(s, d), 100, unit=100),
    "t06_best_rosters_ranked": lambda s, d: groups.best_rosters(t.lines(s, d), 100, by="exact", unit=100, ranked=True),
    "t07_best_roster_per_group": lambda s, d: groups.best_roster_per_group(t.lines(s, d), unit=100),
    "t07_best_roster_per_group_ranked": lambda s, d: groups.best_roster_per_group(t.lines(s, d), unit=100, ranked=True),
    "t08_best_k_periods": lambda s, d: ranking.best_k_periods(t.lines(s, d), 3, 50),
    "t08_best_k_periods_since": lambda s, d: ranking.best_k_periods(t.lines(s, d), 5, 50, since=2001),
    "t09_longest_streak": lambda s, d: streaks.longest_streak(t.lines(s, d), 20_000_000, 100, keep_zero=False),
    "t09_longest_streak_keep_zero": lambda s, d: streaks.longest_streak(t.lines(s, d), 40_000_000, 500),
    "t10_peak_under_cap": lambda s, d: ranking.peak_under_cap(t.lines(s, d), 20_000_000, 100),
    "t10_peak_under_cap_selected": lambda s, d: ranking.peak_under_cap(t.lines(s, d), 20_000_000, 100, show="selected"),
    "t11_low_peak_over_floor": lambda s, d: ranking.low_peak_over_floor(t.lines(s, d), 30_000_000, 50),
    "t11_low_peak_over_floor_by_period": lambda s, d: ranking.low_peak_over_floor(
        t.lines(s, d), 30_000_000, 50, tie=("peak_period", "entity")
    ),
    "t12_cost_per_value_career": lambda s, d: value.cost_per_value(t.lines(s, d), 50),
    "t12_cost_per_value_active": lambda s, d: value.cost_per_value(t.flagged_lines(s, d), 50),
    "t13_costly_negative": lambda s, d: value.costly_negative(t.lines(s, d), 50),
    "t14_costly_periods": lambda s, d: value.costly_periods(t.lines(s, d), 50),
    "t14_costly_periods_group": lambda s, d: value.costly_periods(t.lines(s, d), 50, GROUP),
    "t15_cost_per_value_period": lambda s, d: value.cost_per_value(t.lines(s, d), 50, level="period"),
    "t15_cost_per_value_period_zero_first": lambda s, d: value.cost_per_value(t.lines(s, d), 50, level="period", zero_base="first"),
    "t16_value_per_cost_career": lambda s, d: value.value_per_cost(t.lines(s, d), 50),
    "t16_value_per_cost_since": lambda s, d: value.value_per_cost(t.lines(s, d), 50, since=2001),
    "t16_value_per_cost_active": lambda s, d: value.value_per_cost(t.flagged_lines(s, d), 50),
    "t17_value_per_cost_period": lambda s, d: value.value_per_cost(t.lines(s, d), 50, level="period", since=1999),
    "t18_search_contains": lambda s, d: leaders.search_names(t.lines(s, d), "%77%"),
    "t18_search_prefix": lambda s, d: leaders.search_names(t.lines(s, d), "customer#00000001%"),
    "t18_search_places": lambda s, d: leaders.search_names(t.lines(s, d), "%7%", places=-7),
    "t19_roster_careers": lambda s, d: groups.roster_careers(t.lines(s, d), GROUP, PERIOD),
    "t19_roster_careers_concise": lambda s, d: groups.roster_careers(t.lines(s, d), GROUP, PERIOD, concise=True, unit=100),
    "t19_roster_careers_kept": lambda s, d: groups.roster_careers(_thick(s, d), GROUP, PERIOD, group_order="kept"),
    "t19_roster_careers_places": lambda s, d: groups.roster_careers(t.lines(s, d), GROUP, PERIOD, places=-7),
    "t20_roster_period": lambda s, d: groups.roster_period(t.lines(s, d), GROUP, PERIOD),
    "t20_roster_period_tie_in_period": lambda s, d: groups.roster_period(t.lines(s, d), GROUP, PERIOD, tie="period"),
    "t21_retention": lambda s, d: cohorts.retention(t.lines(s, d), GROUP, 5, 2, 1995, 2001),
    "t21_average_retention": lambda s, d: cohorts.average_retention(
        t.lines(s, d), 5, 3, 1995, 2001, aliases=ALIASES, exclude=["NATION_8"]
    ),
    "t22_relative_retention_self": lambda s, d: cohorts.relative_retention(t.lines(s, d), GROUP, PERIOD, GROUP, LATER),
    "t22_relative_retention_cross": lambda s, d: cohorts.relative_retention(
        t.lines(s, d), GROUP, PERIOD, GROUP, LATER, OTHER_GROUP
    ),
    "t23_extreme_by_primary_category": lambda s, d: ranking.extreme_by_primary_category(t.category_lines(s, d), 3, POSITIONS),
    "t24_long_low_average": lambda s, d: ranking.long_low_average(t.lines(s, d), 5, 4_000_000),
    "t25_measure_leaders_career": lambda s, d: leaders.measure_leaders(t.category_lines(s, d, "measure2"), 50),
    "t25_measure_leaders_period": lambda s, d: leaders.measure_leaders(
        t.category_lines(s, d, "measure2", single_lines=True), 50, level="line"
    ),
    "t26_average_best": lambda s, d: leaders.average_measure(t.category_lines(s, d, "measure2"), 4, 50),
    "t26_average_worst": lambda s, d: leaders.average_measure(t.category_lines(s, d, "measure2"), 4, 50, worst=True),
    "t27_best_by_category": lambda s, d: ranking.extreme_average_by_category(t.category_lines(s, d, "measure2"), 2, FIELDERS),
    "t27_worst_by_category": lambda s, d: ranking.extreme_average_by_category(
        t.category_lines(s, d, source=None), 3, POSITIONS, worst=True
    ),
    "t28_snubs_anti": lambda s, d: awards.award_snubs_anti(
        t.category_lines(s, d, "measure2"), t.awards(s, d), "Gold Glove", 50, since=1996, leagues=t.LEAGUES
    ),
    "t28_worst_winners": lambda s, d: awards.worst_winners(t.category_lines(s, d, "measure2"), t.awards(s, d), "Gold Glove", 50),
    "t29_snubs_scoped": lambda s, d: awards.award_snubs(
        _all(s, d).where(F.col("source") == 1), t.awards(s, d), "Cy Young Award", 50, since=1996, leagues=t.LEAGUES
    ),
    "t30_snubs_two_source": lambda s, d: awards.award_snubs_two_source(
        _all(s, d), t.awards(s, d), "MVP", 50, since=1996, leagues=t.LEAGUES
    ),
    "t31_measure_per_award": lambda s, d: awards.measure_per_award(_all(s, d), t.awards(s, d), "All-Star", 50, since=1996),
    "t31_group_award_average": lambda s, d: awards.group_award_average(
        t.lines(s, d), t.awards(s, d), "All-Star", since=1996, groups=_groups_dim(s, d)
    ),
    "t31_group_award_average_paired": lambda s, d: awards.group_award_average(
        t.lines(s, d), t.awards(s, d), "All-Star", since=1996, groups=_groups_dim(s, d), pair_sources=True
    ),
    "t32_active_total_high": lambda s, d: active.active_total(_all(s, d), 50),
    "t32_active_total_low": lambda s, d: active.active_low_total(_all(s, d), 8, 50),
    "t32_active_total_low_distinct": lambda s, d: active.active_low_total(_all(s, d), 5, 50, count_per_source=False),
    "t32_active_average_high": lambda s, d: active.active_average(_all(s, d), 3, 50, leagues=t.LEAGUES),
    "t32_active_average_low": lambda s, d: active.active_low_average(_all(s, d), 5, 50),
    "t32_active_average_low_paired": lambda s, d: active.active_low_average(_all(s, d), 5, 50, pair_lines=True),
    "j1_awards": lambda s, d: enrich.build_awards(*t.raw_awards(s, d)),
    "j2_awards_list": _j2,
    "j3_ballots": _j3,
    "j4_groups": _j4,
    "j5_category_list_stints": lambda s, d: enrich.category_list(t.raw_fielding(s, d)),
    "j6_category_list_events": _category_events,
    "j7_crosswalk": lambda s, d: enrich.build_crosswalk(t.raw_register(s, d), "key_a", "key_b"),
    "j8_enrich_a": _j8,
    "j9_enrich_b": _j9,
    "a5_unpivot_slots": _slots,
    "a7_line_order": _line_order,
    "b1_union_lines": _opposite_sources,
    "d2_ordered_sum": _ordered_sum,
    "d3_totals_by_source": lambda s, d: rollups.totals_by_source(
        t.lines(s, d), ["entity", "period"], {0: "first_total", 1: "second_total"}
    ),
    "d19_share_filter": _share_filter,
    "d21_sets": lambda s, d: rollups.collections_by_entity(t.lines(s, d)).select(
        "entity", "period", "total",
        *[F.concat_ws(",", F.transform(c, lambda x: x.cast("string"))).alias(c) for c in ("group_set", "league_set", "source_set")],
    ),
    "d22_rates": _batting,
    "d22_rates_pitching": _pitching,
    "e2_top_per_group": _top_three,
    "e3_numbered": _ranked_seasons,
    "e5_islands": _islands,
    "a10_text_report": _text_report,
}

QUERIES |= files.QUERIES

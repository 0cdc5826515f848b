"""SQL of the catalog's reports over the built tables: the checks' templates with the reports' parameters."""

from checks import oracle as o

# all lines of the two files, in ten thousandths; the bat lines' categories and defensive values beside them
TABLES = """
CREATE VIEW awards_table AS SELECT player_ID AS entity, CAST(year_ID AS INTEGER) AS period, award, lg_ID AS league, winner FROM read_parquet('{folder}/awards/*.parquet');
CREATE VIEW teams_table AS SELECT team_id AS group_id, team_name AS group_name FROM read_parquet('{folder}/teams/*.parquet');
CREATE VIEW every_line AS
SELECT player_ID AS entity, name_common AS name, CAST(year_ID AS INTEGER) AS period, upper(team_ID) AS grp, lg_ID AS league, 0 AS source, line_no,
  CAST(round(WAR * 10000) AS BIGINT) AS measure, CAST(round(WAR_def * 10000) AS BIGINT) AS measure2, salary AS cost, position AS category
FROM read_parquet('{folder}/war_daily_bat/*.parquet')
UNION ALL
SELECT player_ID, name_common, CAST(year_ID AS INTEGER), upper(team_ID), lg_ID, 1, line_no, CAST(round(WAR * 10000) AS BIGINT), NULL, salary, positions
FROM read_parquet('{folder}/war_daily_pitch/*.parquet');
"""

CAREER = "name, round(total / 10000.0, 2) AS career_war, periods AS season_count, span AS year_range, groups AS teams"
SEASON = "name, round(total / 10000.0, 2) AS war, period AS year, groups AS teams"
STREAK = "name, periods AS season_count, span AS year_range, groups AS teams"
PEAK = (
    "name, round(total / 10000.0, 2) AS career_war, CAST(round(peak_total / 10000.0, 2) AS DOUBLE) || ' (' || peak_period || ')' AS peak_war, "
    "periods AS season_count, span AS year_range, groups AS teams"
)
PRINTED = "round(total / 10000.0, 2)"


def adapted(key: str, *changes: tuple[str, str], columns: str, lower: bool = False, last: str = "") -> str:
    """A template over the built tables; every change must be found in it."""
    sql = o.ORACLE[key]
    sql = sql.replace(o._star(), "star AS (SELECT * REPLACE (" + ("lower" if lower else "upper") + "(grp) AS grp) FROM every_line)")
    sql = sql.replace(f"league IN ({o._LG}) AND TRUE", "league IN ('AL', 'NL') AND measure IS NOT NULL").replace(o._LG, "'AL', 'NL'")
    sql = sql.replace("WHERE TRUE AND source = 1", "WHERE source = 1")
    for old, new in changes:
        assert old in sql, (key, old, sql)
        sql = sql.replace(old, new)
    return f"SELECT {columns} FROM ({sql}) {last}"


def lines_of(year: str) -> tuple[tuple[str, str], ...]:
    """For templates whose lines are those of one period."""
    return ((f"league IN ('AL', 'NL') AND {year}", f"league IN ('AL', 'NL') AND measure IS NOT NULL AND {year}"),)


TEAM, OTHER = "'NATION_3'", "'NATION_11'"


def reports():
    kept = ((o._APPEAR["slot"], o._APPEAR["kept"]),)
    yield "career_leaders", adapted("t01_career_leaders", *kept, ("total DESC", f"{PRINTED} DESC"), ("LIMIT 100", "LIMIT 10"), columns=CAREER)
    yield "season_leaders", adapted("t02_period_leaders_top", ("LIMIT 100", "LIMIT 10"), columns=SEASON)
    yield "season_trailers", adapted("t02_period_leaders_bottom", ("LIMIT 100", "LIMIT 10"), columns=SEASON)
    yield "log_ruthba01", adapted("t03_entity_log", ("s.entity = 137", "s.entity = 'ruthba01'"), columns=SEASON)
    yield "average_leaders", adapted("t04_average_leaders", columns=CAREER + ", round(average / 10000.0 + sign(average) * 1e-9, 2) AS average_war")
    for team in ("BOS", "NYY"):
        mine = (TEAM, f"'{team}'")
        yield f"team_{team.lower()}_best_30", adapted("t05_group_best", *kept, mine, ("ORDER BY total", f"ORDER BY {PRINTED}"), columns=CAREER)
        yield f"team_{team.lower()}_worst_30", adapted("t05_group_worst_places", *kept, mine, (o._SHOWN, PRINTED), ("LIMIT 200", "LIMIT 30"), columns=CAREER)
    yield "team_bos_best", adapted("t05_group_best", *kept, (TEAM, "'BOS'"), ("LIMIT 30", ""), columns=CAREER)
    yield "team_bos_worst", adapted("t05_group_worst", (TEAM, "'BOS'"), columns=CAREER)
    whole, rosters = ("total / 100.0", "total / 10000.0"), "period AS year, grp AS team, rounded AS war"
    yield "best_rosters", adapted("t06_best_rosters", whole, ("LIMIT 100", "LIMIT 1000"), columns=rosters, lower=True)
    yield "best_rosters_concise", adapted("t06_best_rosters_ranked", whole, ("rk <= 100", "rk <= 1000"), columns="rank_label, " + rosters, lower=True)
    yield "best_roster_per_team", adapted("t07_best_roster_per_group", whole, columns=rosters, lower=True)
    yield "best_roster_per_team_concise", adapted("t07_best_roster_per_group_ranked", whole, columns="rank_label, " + rosters, lower=True)
    for k in (3, 5, 7):
        printed = ("ORDER BY total DESC, i.first_line LIMIT 50", "ORDER BY round(CAST(sum(c.total) AS BIGINT) / 10000.0, 2) DESC, i.first_line LIMIT 50")
        yield f"best_{k}_seasons", adapted("t08_best_k_periods", ("rk <= 3", f"rk <= {k}"), printed, columns=CAREER)
        yield f"best_{k}_seasons_since_1947", adapted("t08_best_k_periods_since", ("rk <= 5", f"rk <= {k}"), (">= 2001", ">= 1947"), printed, columns=CAREER)
    for t in range(5, 15):
        if t in (8, 9):
            yield f"streak_over_{t}", adapted("t09_longest_streak", ("> 20000000", f"> {t}0000"), ("LIMIT 100", "LIMIT 50"), columns=STREAK)
        else:
            yield f"streak_over_{t}", adapted("t09_longest_streak_keep_zero", ("> 40000000", f"> {t}0000"), ("LIMIT 500", "LIMIT 50"), columns=STREAK)
    for cap in (10, 15, 20, 30):
        key = "t10_peak_under_cap_selected" if cap == 10 else "t10_peak_under_cap"
        yield f"peak_under_{cap}", adapted(key, ("< 20000000", f"< {cap}0000"), ("LIMIT 100", "LIMIT 20"), columns=PEAK)
    for floor in range(40, 161, 10):
        tie = "p.period, b.entity" if floor == 90 else "b.first_line" if 100 <= floor <= 150 else "b.entity"
        yield f"low_peak_over_{floor}", adapted("t11_low_peak_over_floor", ("> 30000000", f"> {floor}0000"), ("p.total, b.first_line LIMIT 50", f"p.total, {tie} LIMIT 20"), columns=PEAK)
    cost, top20, first = ", cost AS salary", ("LIMIT 50", "LIMIT 20"), ("NULLS LAST", "NULLS FIRST")
    yield "costly_careers", adapted("t12_cost_per_value_career", top20, first, columns=CAREER + cost)
    yield "costly_careers_active", adapted("t12_cost_per_value_active", top20, first, columns=CAREER + cost)
    yield "costly_careers_negative", adapted("t13_costly_negative", top20, columns=CAREER + cost)
    yield "costly_seasons", adapted("t14_costly_periods", top20, columns=SEASON + cost)
    for team in ("BOS", "NYY"):
        yield f"costly_seasons_{team.lower()}", adapted("t14_costly_periods_group", top20, (TEAM, f"'{team}'"), columns=SEASON + cost)
    yield "costly_seasons_per_war", adapted("t15_cost_per_value_period_zero_first", top20, columns=SEASON + cost)
    for since in (None, 1947, 2000):
        name = f"_since_{since}" if since else ""
        yield "value_careers" + name, adapted("t16_value_per_cost_since", top20, ("hi >= 2001", f"hi >= {since or 0}"), columns=CAREER + cost)
        yield "value_seasons" + name, adapted("t17_value_per_cost_period", top20, (">= 1999", f">= {since or 0}"), columns=SEASON + cost)
    yield "value_careers_active", adapted("t16_value_per_cost_active", top20, columns=CAREER + cost)
    for name, pattern in (("contains_war", "%war%"), ("starts_babe", "babe %"), ("starts_cecil", "cecil %")):
        yield f"name_{name}", adapted("t18_search_contains", ("%77%", pattern), columns=CAREER)
    for year, team in ((1928, "PHA"), (1959, "MLN"), (1996, "CLE"), (2005, "NYY")):
        yield f"roster_{year}_{team.lower()}", adapted("t19_roster_careers", *kept, (TEAM, f"'{team}'"), ("1998", str(year)), columns=CAREER)
    for year, team in ((1928, "PHA"), (2005, "NYY")):
        yield f"roster_{year}_{team.lower()}_concise", adapted("t19_roster_careers_concise", whole, (TEAM, f"'{team}'"), ("1998", str(year)), columns="name, rounded AS war")
    for year in (2019, 2022):
        for team in ("BOS", "NYY", "OAK"):
            if year == 2019 and team != "OAK":
                sql = adapted("t20_roster_period", (TEAM, f"'{team}'"), ("1998", str(year)), columns=SEASON)
            else:
                sql = adapted("t20_roster_period_tie_in_period", ("league IN ('AL', 'NL') AND period", "league IN ('AL', 'NL') AND measure IS NOT NULL AND period"), (TEAM, f"'{team}'"), ("1998", str(year)), columns=SEASON)
            yield f"season_{year}_{team.lower()}", sql
    spell = lambda k, gap: (("period >= 1995", "period >= 2000"), (f"+ {gap} <= 2001", f"+ {gap} <= 2022"), ("roll[:5]", f"roll[:{k}]"))
    for team in ("bos", "oak"):
        yield f"retention_{team}", adapted(
            "t21_retention", *spell(5, 2), (TEAM, f"'{team}'"), ("period + 2", "period + 3"),
            columns="from_period AS from_year, to_period AS to_year, retained", lower=True,
        )
    moved = ("WHEN 'NATION_1' THEN 'NATION_2' WHEN 'NATION_7' THEN 'NATION_8' WHEN 'NATION_12' THEN 'NATION_3'", "WHEN 'mon' THEN 'wsn' WHEN 'ana' THEN 'laa' WHEN 'ath' THEN 'oak'")
    for k in (3, 5):
        yield f"average_retention_top_{k}", adapted(
            "t21_average_retention", *spell(k, 3), moved, ("min(period) <= 1995", "min(period) <= 2000"), ("max(period) >= 2001", "max(period) >= 2022"), ("'NATION_8'", "'laa'"),
            columns="grp AS team, average_retained AS average_years", lower=True,
        )
    for kept_year, target in ((2019, None), (2022, None), (2022, "BOS"), (2022, "NYY")):
        of_year = ("league IN ('AL', 'NL') AND period", "league IN ('AL', 'NL') AND measure IS NOT NULL AND period")
        oak = [of_year, (TEAM, "'OAK'"), ("2000", str(kept_year)), ("1998", "2019"), (OTHER, f"'{target or 'OAK'}'")]
        yield f"relative_retention_oak_{kept_year}_{(target or 'oak').lower()}", adapted("t22_relative_retention_cross" if target else "t22_relative_retention_self", *oak, columns=SEASON)

    # reports by category and award: the tables have the lists themselves
    def categories(key, measure, source, *changes, columns):
        sql = o.ORACLE[key]
        at = sql.index("bat AS (\n")
        end = sql.index(f"WHERE {source}\n)") + len(f"WHERE {source}\n)")
        where = "measure IS NOT NULL" if source == "TRUE" else f"{source} AND measure IS NOT NULL"
        body = f"WITH bat AS (SELECT * FROM (SELECT * EXCLUDE (measure, measure2), {measure} AS measure FROM every_line) WHERE {where})" + sql[end:]
        assert at < end
        body = body.replace(o._LG, "'AL', 'NL'").replace(o._AWARDS, ", awards AS (SELECT entity, period, award, league FROM awards_table WHERE winner)")
        for old, new in changes:
            assert old in body, (key, old, body)
            body = body.replace(old, new)
        return f"SELECT {columns} FROM ({body})"

    by_position = "category AS position, name AS player, periods AS seasons, round(average / 10000.0, 2) AS average"
    yield "low_careers_by_position", categories(
        "t23_extreme_by_primary_category", "measure", "source = 0", ("best.n <= -3", "best.n <= -10"),
        columns="category AS position, name AS player, periods AS seasons, round(total / 10000.0, 1) AS career_war",
    )
    yield "long_low_careers", adapted("t24_long_low_average", ("periods >= 5", "periods >= 10"), ("< 4000000", "< 5000"), columns=CAREER)
    yield "defence_careers", categories("t25_measure_leaders_career", "measure2", "source = 0", ("ORDER BY total", "ORDER BY round(total / 10000.0, 1)"), ("LIMIT 50", "LIMIT 10"), columns="name AS player, round(total / 10000.0, 1) AS career_dwar")
    yield "defence_seasons", categories("t25_measure_leaders_period", "measure2", "source = 0", ("LIMIT 50", "LIMIT 10"), columns="name AS player, period AS year, grp AS team, league, category AS position, measure / 10000.0 AS dwar")
    yield "defence_average_best", categories("t26_average_best", "measure2", "source = 0", (">= 4", ">= 5"), ("ORDER BY average DESC", "ORDER BY round(average / 10000.0, 3) DESC"), ("LIMIT 50", "LIMIT 20"), columns="name AS player, periods AS seasons, round(average / 10000.0, 3) AS average, round(total / 10000.0, 1) AS career_dwar, categories AS positions")
    yield "defence_average_worst", categories("t26_average_worst", "measure2", "source = 0", (">= 4", ">= 5"), ("ORDER BY average, entity", "ORDER BY round(average / 10000.0, 2), entity, name"), ("LIMIT 50", "LIMIT 20"), columns="name AS player, categories AS position, periods AS seasons, round(average / 10000.0, 2) AS average")
    yield "defence_best_by_position", categories("t27_best_by_category", "measure2", "source = 0", (">= 2", ">= 10"), columns=by_position)
    yield "worst_by_position", categories("t27_worst_by_category", "measure", "TRUE", (">= 3", ">= 10"), columns=by_position)
    gold = "name AS player, period AS season, grp AS team, category AS position, round(total / 10000.0, 1) AS dwar"
    yield "gold_glove_snubs", categories("t28_snubs_anti", "measure2", "source = 0", ("period >= 1996", "period >= 1957"), ("LIMIT 50", "LIMIT 20"), columns=gold)
    yield "gold_glove_worst", categories("t28_worst_winners", "measure2", "source = 0", ("LIMIT 50", "LIMIT 20"), columns=gold)
    won = (o._AWARDS, ", awards AS (SELECT entity, period, award, league FROM awards_table WHERE winner)")
    snub = "period AS season, league, name AS player, round(total / 10000.0, 1) AS war, winner_name AS winner, round(winner_total / 10000.0, 1) AS winner_war, round(advantage / 10000.0, 1) AS advantage"
    yield "cy_young_snubs", adapted("t29_snubs_scoped", won, (">= 1996", ">= 1956"), ("LIMIT 50", "LIMIT 20"), columns=snub)
    yield "mvp_snubs", adapted(
        "t30_snubs_two_source", won, ("FROM star WHERE TRUE AND TRUE", "FROM star WHERE measure IS NOT NULL"), (">= 1996", ">= 1922"),
        ("ORDER BY advantage", "ORDER BY round(advantage / 10000.0, 1)"), ("LIMIT 50", "LIMIT 20"), columns=snub,
    )
    start, end = o.ORACLE["t31_group_award_average_paired"].index("dim AS ("), o.ORACLE["t31_group_award_average_paired"].index("chosen AS (")
    yield "team_all_stars", adapted(
        "t31_group_award_average_paired", won, (o.ORACLE["t31_group_award_average_paired"][start:end], "dim AS (SELECT * FROM teams_table),\n"), (">= 1996", ">= 1933"),
        columns="group_name AS team, times AS all_stars, round(average / 10000.0, 2) AS average",
    )
    yield "war_per_all_star", adapted("t31_measure_per_award", won, (">= 1996", ">= 1933"), ("t.total AS DOUBLE) / c.times", "t.total AS DOUBLE) / 10000.0 / c.times"), ("ORDER BY per_award", "ORDER BY round(per_award, 2)"), columns="name AS player, round(total / 10000.0, 1) AS career_war, times AS all_stars, round(per_award, 2) AS per_all_star")
    yield "active_careers_high", adapted("t32_active_total_high", ("ORDER BY total", "ORDER BY round(total / 10000.0, 1)"), ("LIMIT 50", "LIMIT 20"), columns="name AS player, round(total / 10000.0, 1) AS career_war")
    yield "active_average_high", adapted("t32_active_average_high", ("ORDER BY average", "ORDER BY round(average / 10000.0, 2)"), ("LIMIT 50", "LIMIT 20"), columns="name AS player, periods AS seasons, round(average / 10000.0, 2) AS average, round(total / 10000.0, 1) AS career_war")
    yield "active_careers_low", adapted("t32_active_total_low", ("FROM star GROUP BY entity, source", "FROM star WHERE measure IS NOT NULL GROUP BY entity, source"), ("ORDER BY total", "ORDER BY round(sum(total) / 10000.0, 1)"), ("LIMIT 50", "LIMIT 10"), columns="name AS player, periods AS seasons, round(total / 10000.0, 1) AS career_war, last_period AS last_season")
    yield "active_average_low", adapted(
        "t32_active_average_low_paired", ("(SELECT * FROM star WHERE source = 0) b", "(SELECT * FROM star WHERE source = 0 AND measure IS NOT NULL) b"), (">= 5", ">= 8"),
        ("ORDER BY average", "ORDER BY round(average / 10000.0, 2)"), ("LIMIT 50", "LIMIT 10"),
        columns="name AS player, periods AS seasons, round(average / 10000.0, 2) AS average, round(total / 10000.0, 2) AS career_war",
    )


REPORTS = dict(reports())

"""Raw files -> tables -> all reports, on a small made-up league."""

import csv
import os
import random
import sys
from collections import Counter, defaultdict
from decimal import Decimal

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import report_sql  # noqa: E402

from pennant.operators import enrich, leaders
from pennant.plans.catalog import CATALOG, Book, run_catalog, run_report
from pennant.plans.reports import labelled, text_lines
from pennant.plans.season_tables import Inputs, build_tables

LINE = ["name_common", "player_ID", "year_ID", "team_ID", "stint_ID", "lg_ID", "G", "GS", "WAR", "WAR_def", "salary"]
TEAMS = ["BOS", "NYY", "OAK", "CLE", "PHA", "MON", "WSN"]


def _write(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)
    return str(path)


def _league(seed=11):
    rng = random.Random(seed)
    bat, pitch = [], []
    for i in range(70):
        pid, name = f"play{i:02d}", rng.choice(["Babe", "Cecil", "Hank", "Al"]) + (" Ward" if i % 9 == 0 else f" Doe{i}")
        first = rng.choice([1925, 1950, 1995, 2005, 2012])
        pitcher, lg = i % 3 == 0, rng.choice(["AL", "NL"])
        for year in range(first, first + rng.randint(2, 14)):
            stints = rng.choice([1, 1, 1, 2])
            for s in range(1, stints + 1):
                team = rng.choice(TEAMS)
                war = f"{rng.gauss(4, 4):.2f}" if rng.random() > 0.02 else "NULL"
                salary = str(rng.randint(1, 900) * 1000) if rng.random() > 0.3 else "NULL"
                g = rng.randint(5, 150)
                line = [name, pid, year, team, s, lg if rng.random() > 0.03 else "FL", g, rng.randint(0, g), war, f"{rng.gauss(0, 1):.2f}", salary]
                bat.append(line)
                if pitcher:
                    pitch.append([*line[:8], f"{rng.gauss(1, 3):.2f}", "", line[10]])
    return bat, pitch


@pytest.fixture(scope="module")
def league():
    return _league()


@pytest.fixture(scope="module")
def folder(spark, league, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("tables")
    bat, pitch = league
    rng = random.Random(5)
    seasons = sorted({(r[1], r[2], r[5]) for r in bat})
    pick = [s for s in seasons if rng.random() < 0.3]
    header_bat = ["playerID", "yearID", *enrich.BATTING_COUNTS]
    header_pit = ["playerID", "yearID", *enrich.PITCHING_COUNTS]
    inputs = Inputs(
        bat_lines=_write(raw / "bat.txt", LINE, bat),
        pitch_lines=_write(raw / "pitch.txt", LINE, pitch),
        batting=_write(raw / "Batting.csv", header_bat, [[p.upper(), y, *[rng.randint(0, 50) for _ in enrich.BATTING_COUNTS]] for p, y, _ in seasons]),
        pitching=_write(raw / "Pitching.csv", header_pit, [[p, y, *[rng.randint(0, 50) for _ in enrich.PITCHING_COUNTS]] for p, y, _ in seasons[::3]]),
        fielding=_write(raw / "Fielding.csv", ["playerID", "yearID", "stint", "POS", "G"], [[p, y, 1, rng.choice(["SS", "OF", "C", "PH"]), rng.randint(1, 90)] for p, y, _ in seasons for _ in "ab"]),
        awards=_write(
            raw / "Awards.csv", ["playerID", "awardID", "yearID", "lgID", "tie", "notes"],
            [[p, rng.choice(["Most Valuable Player", "TSN Guide MVP", "Gold Glove", "Cy Young Award", "Rookie of the Year"]), y, g, "", ""] for p, y, g in pick],
        ),
        award_shares=_write(
            raw / "Shares.csv", ["awardID", "yearID", "lgID", "playerID", "pointsWon", "pointsMax", "votesFirst"],
            [["Cy Young Award", y, g, p, rng.randint(0, 50), 50, 1] for p, y, g in pick[::2]],
        ),
        selections=_write(
            raw / "AllStar.csv", ["playerID", "yearID", "gameNum", "gameID", "teamID", "lgID", "GP", "startingPos"],
            [[p, y, 0, "x", "X", g, 1, 9] for p, y, g in seasons if y >= 1933 and rng.random() < 0.5],
        ),
        ballots=_write(raw / "Hof.csv", ["playerID", "yearID", "votedBy", "ballots", "needed", "votes", "inducted", "category", "needed_note"], [["play01", 1980, "V", "10", "8", "9", "Y", "Player", ""]]),
        teams=_write(raw / "teams.csv", ["team_id", "team_name", "lg_id"], [[t.lower(), f"Team {t}", "AL"] for t in TEAMS[:5]]),
        game_logs=_write_logs(raw / "gl.txt", seasons, rng),
        register=_write(raw / "people-0.csv", ["key_person", "key_retro", "key_bbref"], [[i, f"r{i:02d}", f"play{i:02d}"] for i in range(0, 70, 2)]),
    )
    written = build_tables(spark, inputs, str(out))
    assert set(written) == {
        "retrosheet_positions", "id_crosswalk", "lahman_positions", "awards", "hall_of_fame", "teams", "war_daily_bat", "war_daily_pitch", "stints",
    }
    return str(out)


def _write_logs(path, seasons, rng):
    lines = []
    for p, y, _ in seasons[::2]:
        row = [f"{y}0401"] + [""] * 160
        row[105], row[106], row[107] = "r" + p[4:], "Some, One", str(rng.randint(1, 11))
        lines.append(",".join(f'"{v}"' for v in row))
    path.write_text("\n".join(lines))
    return str(path)


@pytest.fixture(scope="module")
def book(spark, folder):
    return Book.open(spark, folder)


def _kept(league):
    """Counted lines in order: batting first."""
    return [(s, i, r) for s, rows in enumerate(league) for i, r in enumerate(rows) if r[8] != "NULL" and r[5] in ("AL", "NL")]


def test_tables_keep_every_line(spark, league, folder):
    bat = spark.read.parquet(f"{folder}/war_daily_bat").orderBy("line_no").collect()
    assert [(r.player_ID, r.year_ID, r.team_ID, r.stint_ID) for r in bat] == [(r[1], r[2], r[3], r[4]) for r in league[0]]
    assert {"position", "positions_retro", "positions_lahman", "AVG", "OBP", "SLG", "awards"} <= set(bat[0].asDict())
    assert all(r.AB is None for r in bat if r.stint_ID != 1) and all(r.AB is not None for r in bat if r.stint_ID == 1)
    pitch = spark.read.parquet(f"{folder}/war_daily_pitch")
    assert pitch.count() == len(league[1]) and pitch.where("positions is null").count() == 0
    assert {"IP", "ERA", "lh_GS"} <= set(pitch.columns)


def test_there_are_103_reports():
    assert len(CATALOG) == 103


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_report_runs(book, name):
    report = CATALOG[name]
    df = run_report(book, name)
    assert {f.column for f in report.layout if f.column} == set(df.columns)
    df.collect()


@pytest.fixture(scope="module")
def database(folder):
    con = duckdb.connect()
    con.execute(report_sql.TABLES.format(folder=folder))
    return con


def _plain(v):
    return round(float(v), 6) if isinstance(v, (float, Decimal)) else v


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_report_values(book, database, name):
    rows = run_report(book, name)
    mine = Counter(tuple(_plain(r[c]) for c in sorted(rows.columns)) for r in rows.collect())
    result = database.execute(report_sql.REPORTS[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(rows.columns)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert mine == Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())


def test_most_reports_have_rows(book, database):
    empty = [name for name in CATALOG if not database.execute(report_sql.REPORTS[name]).fetchall()]
    assert len(empty) < 30


def test_season_and_career_leaders(book, league):
    seasons, careers = defaultdict(list), defaultdict(list)
    for key in _kept(league):
        seasons[(key[2][1], key[2][2])].append(key)
        careers[key[2][1]].append(key)

    def total(keys):
        return sum(Decimal(k[2][8]) for k in keys)

    best = sorted(seasons.values(), key=lambda ks: (-total(ks), min(k[:2] for k in ks)))[:10]
    expect = [(ks[0][2][0], float(total(ks)), ks[0][2][2], ",".join(dict.fromkeys(k[2][3] for k in ks))) for ks in best]
    assert [(r.name, r.war, r.year, r.teams) for r in run_report(book, "season_leaders").collect()] == expect
    expect = sorted(((-total(ks), ks[0][2][0], p) for p, ks in careers.items()))[:10]
    got = run_report(book, "career_leaders").collect()
    assert [(r.career_war, r.name) for r in got] == [(float(-t), n) for t, n, _ in expect]


def test_longest_streaks(book, league):
    careers = defaultdict(dict)
    first_line = {}
    for source, i, r in _kept(league):
        careers[r[1]].setdefault(r[2], []).append((source, i, Decimal(r[8])))
        first_line.setdefault(r[1], (source, i))
    expect = []
    for player, years in careers.items():
        ordered = sorted(years.items(), key=lambda kv: min(x[:2] for x in kv[1]))
        best = run = 0
        for _, rows in ordered:
            run = run + 1 if sum(x[2] for x in rows) > 5 else 0
            best = max(best, run)
        expect.append((-best, first_line[player], player))
    expect = [-b for b, _, _ in sorted(expect)[:50]]
    assert [r.season_count for r in run_report(book, "streak_over_5").collect()] == expect


def test_text_output(spark, book, tmp_path):
    assert run_catalog(book, str(tmp_path), ["career_leaders", "average_leaders"]) == ["career_leaders", "average_leaders"]
    report = CATALOG["career_leaders"]
    rows = run_report(book, "career_leaders").collect()
    text = [r.value for r in spark.read.text(str(tmp_path / "career_leaders" / "text")).collect()]
    assert text[:3] == [report.title, "10 rows", ""]
    assert text[3].split() == ["#", "name", "war", "seasons", "teams"]
    assert text[4] == f"  #1: {rows[0].name:<20} {rows[0].career_war!s:>10} {rows[0].season_count:>7} {rows[0].year_range:<11} {rows[0].teams}"
    assert len(text) == 14 and all(line == line.rstrip() for line in text)
    table = spark.read.parquet(str(tmp_path / "average_leaders" / "table")).orderBy("rank").collect()
    assert [r.c1 for r in table] == [r.name for r in run_report(book, "average_leaders").collect()]
    assert [r.c0 for r in table] == [f"#{i + 1}:" for i in range(len(table))]


def test_a_stopped_run_goes_on_where_it_stopped(spark, book, folder, tmp_path, monkeypatch):
    from pennant.plans import catalog

    names, out = ["career_leaders", "season_leaders", "log_ruthba01"], str(tmp_path)
    write, calls = catalog.write_report, []

    def stops(df, report, to):
        if report.name == "log_ruthba01" and "log_ruthba01" not in calls:
            calls.append(report.name)
            raise RuntimeError("driver lost")
        calls.append(report.name)
        write(df, report, to)

    monkeypatch.setattr(catalog, "write_report", stops)
    with pytest.raises(RuntimeError):
        run_catalog(book, out, names)
    assert run_catalog(book, out, names, resume=True) == ["log_ruthba01"]
    assert run_catalog(book, out, names, resume=True) == []
    (tmp_path / "season_leaders" / "text" / "_SUCCESS").unlink()  # no longer whole
    assert run_catalog(book, out, names, resume=True) == ["season_leaders"]
    other = Book.open(spark, folder, stints=False)  # made from other tables
    assert run_catalog(other, out, ["career_leaders"], resume=True) == ["career_leaders"]
    assert run_catalog(book, out, names[:1]) == ["career_leaders"]


@pytest.mark.parametrize(
    "name", ["career_leaders", "season_leaders", "average_leaders", "team_bos_best", "best_rosters", "best_5_seasons", "streak_over_5",
             "peak_under_20", "costly_seasons", "value_careers", "name_starts_babe", "roster_2005_nyy", "retention_bos", "long_low_careers"],
)
def test_reports_of_stored_stints_do_not_move_entities(book, name):
    plan = run_report(book, name)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(entity" not in plan and "Bucketed: true" in plan


def test_one_entity_reads_one_bucket(book):
    plan = run_report(book, "log_ruthba01")._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of" in plan


def test_groups_follow_positions_among_counted_lines(book, league):
    first = {}
    for source, rows in enumerate(league):
        kept = [r for r in rows if r[8] != "NULL" and r[5] in ("AL", "NL")]
        for position, r in enumerate(kept):
            key = (r[1], r[3])
            first[key] = min(first.get(key, (position, source)), (position, source))
    expect = {}
    for player in {p for p, _ in first}:
        expect[player] = ",".join(t for t, _ in sorted(((t, first[p, t]) for p, t in first if p == player), key=lambda x: x[1]))
    got = {r.entity: r.groups for r in leaders.career_leaders(book.lines, 1000, group_order="kept").collect()}
    assert got == expect
    plain = Book(book.bat, book.pitch).lines
    assert {r.entity: r.groups for r in leaders.career_leaders(plain, 1000, group_order="kept").collect()} == expect


def test_nulls_print_as_blank(spark, book):
    layout = CATALOG["streak_over_14"].layout
    df = spark.createDataFrame([("A", 0, None, None)], "name string, season_count long, year_range string, teams string")
    lines = text_lines(labelled(df, layout), "T", layout).orderBy("rank").collect()
    assert lines[-1].line == "  #1: A" + " " * 26 + "0"


def test_only_the_line_files(spark, league, tmp_path):
    bat, pitch = league
    inputs = Inputs(_write(tmp_path / "b.txt", LINE, bat), _write(tmp_path / "p.txt", LINE, pitch))
    assert build_tables(spark, inputs, str(tmp_path / "out")) == ["war_daily_bat", "war_daily_pitch", "stints"]
    book = Book.open(spark, str(tmp_path / "out"), awards=False, teams=False)
    assert set(book.bat.columns) == {*LINE, "line_no"}
    assert run_report(book, "season_leaders").count() == 10

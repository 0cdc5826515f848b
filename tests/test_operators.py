import random
from collections import defaultdict
from decimal import Decimal

import pytest

from pennant.operators import active, awards, cohorts, groups, leaders, ranking, streaks, value


def tuples(df, *columns):
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in (r[c] for c in columns)) for r in df.collect()]


@pytest.fixture(scope="module")
def two_source(make_lines):
    return make_lines(
        [
            ("p1", "Old Name", 2001, "BOS", 0, "1.25"),
            ("p1", "Old Name", 2001, "NYY", 0, "0.75"),
            ("p2", "Zed", 2001, "NYY", 0, "3.00"),
            ("p1", "New Name", 2002, "CLE", 0, "5.00"),
            ("p1", "Old Name", 2001, "OAK", 1, "-0.50"),
            ("p2", "Zed", 2003, "BOS", 1, "3.50"),
        ]
    )


def test_career_and_season_leaders(two_source):
    got = tuples(leaders.career_leaders(two_source, 10, group_order="line"), "entity", "name", "total", "periods", "span", "groups")
    assert got == [
        ("p1", "Old Name", 6.5, 2, "(2001-2002)", "BOS,NYY,CLE,OAK"),
        ("p2", "Zed", 6.5, 2, "(2001-2003)", "NYY,BOS"),
    ]
    # interleaved: the first OAK line is line 1 of its own source
    assert tuples(leaders.career_leaders(two_source, 1), "groups") == [("BOS,OAK,NYY,CLE",)]
    assert tuples(leaders.average_leaders(two_source), "entity", "average", "groups")[0] == ("p1", 3.25, "BOS,NYY,OAK,CLE")
    assert tuples(leaders.period_leaders(two_source, 2), "entity", "period", "total", "groups") == [
        ("p1", 2002, 5.0, "CLE"), ("p2", 2003, 3.5, "BOS"),
    ]
    assert tuples(leaders.period_leaders(two_source, 1, worst=True), "entity", "total", "groups") == [("p1", 1.5, "BOS,NYY,OAK")]
    assert tuples(leaders.entity_log(two_source, "p1"), "name", "period") == [("Old Name", 2001), ("New Name", 2002)]


def test_search_uses_the_first_name(two_source):
    assert tuples(leaders.search_names(two_source, "old%"), "entity", "total") == [("p1", 6.5)]
    assert tuples(leaders.search_names(two_source, "%NEW%"), "entity") == []


def test_groups(two_source):
    assert tuples(groups.group_career_leaders(two_source, "OAK"), "entity") == [("p1",)]
    best = tuples(groups.best_rosters(two_source, 10, by="exact", ranked=True), "rank_label", "period", "grp", "rounded")
    # both careers are 6.5, so rosters with both members come first (13), the others sort by first member
    assert best[0] == ("1:", 2001, "NYY", 13)
    assert [b[1:3] for b in best[1:]] == [(2001, "BOS"), (2002, "CLE"), (2001, "OAK"), (2003, "BOS")]
    per_group = tuples(groups.best_roster_per_group(two_source), "period", "grp", "rounded")
    assert per_group == [(2001, "NYY", 13), (2001, "BOS", 7), (2002, "CLE", 7), (2001, "OAK", 7)]
    assert tuples(groups.roster_careers(two_source, "BOS", 2003), "entity") == [("p2",)]
    assert tuples(groups.roster_period(two_source, "NYY", 2001), "entity", "total", "groups") == [
        ("p2", 3.0, "NYY"), ("p1", 1.5, "BOS,NYY,OAK"),
    ]


def test_streaks(make_lines):
    lines = make_lines(
        # a: a missed year (2003) inside a run must not break it
        [("a", "A", y, "X", 0, 6) for y in (2000, 2001, 2002, 2004)] + [("a", "A", 2005, "X", 0, 1)]
        # b: two runs of two; the second has the higher total
        + [("b", "B", 2000, "X", 0, 6), ("b", "B", 2001, "X", 0, 6), ("b", "B", 2002, "X", 0, 0),
           ("b", "B", 2003, "Y", 0, 7), ("b", "B", 2004, "Z", 0, 7)]
        # c: never over; exactly the threshold does not count
        + [("c", "C", 2000, "X", 0, 5)]
    )
    got = tuples(streaks.longest_streak(lines, 5, 10), "entity", "periods", "span", "groups")
    assert got == [("a", 4, "(2000-2004)", "X"), ("b", 2, "(2003-2004)", "Y,Z"), ("c", 0, None, None)]
    assert len(tuples(streaks.longest_streak(lines, 5, 10, keep_zero=False), "entity")) == 2


def test_best_seasons_and_peaks(make_lines):
    lines = make_lines(
        [("a", "A", 1940, "X", 0, 5), ("a", "A", 1941, "Y", 0, 3), ("a", "A", 1950, "Z", 0, 4),
         ("b", "B", 1930, "X", 0, 9), ("b", "B", 1931, "W", 0, 1)]
    )
    got = tuples(ranking.best_k_periods(lines, 2, 10), "entity", "total", "span", "groups")
    assert got == [("b", 10.0, "(1930-1931)", "X,W"), ("a", 9.0, "(1940-1950)", "X,Z")]
    assert tuples(ranking.best_k_periods(lines, 2, 10, since=1947), "entity") == [("a",)]
    selected = tuples(ranking.peak_under_cap(lines, 11, 10, show="selected"), "entity", "peak_total", "peak_period")
    assert selected == [("b", 9.0, 1930), ("b", 1.0, 1931)]
    peak = tuples(ranking.peak_under_cap(lines, 11, 10), "entity", "peak_total", "peak_period")
    assert peak == [("b", 9.0, 1930), ("b", 9.0, 1930)]
    low = tuples(ranking.low_peak_over_floor(lines, 5, 10, tie=("entity",)), "entity", "peak_total", "peak_period")
    assert low == [("a", 5.0, 1940), ("b", 9.0, 1930)]
    assert tuples(ranking.long_low_average(lines, 3, 4.5), "entity") == [("a",)]


def test_value(make_lines):
    lines = make_lines(
        [("low", "L", 2000, "X", 0, -2, 100), ("mid", "M", 2000, "X", 0, 0, 300), ("mid", "M", 2000, "Y", 1, 0, 0),
         ("top", "T", 2000, "X", 0, 8, 100), ("free", "F", 2000, "X", 0, 1, 0)]
    )
    # the lowest total has a zero base: last, or first when asked for
    assert tuples(value.cost_per_value(lines, 10), "entity", "cost") == [("mid", 150), ("top", 100), ("low", 100)]
    assert [e for (e,) in tuples(value.cost_per_value(lines, 10, level="period", zero_base="first"), "entity")] == ["low", "mid", "top"]
    assert tuples(value.costly_negative(lines, 10), "entity") == [("low",)]
    assert tuples(value.costly_periods(lines, 10, "Y"), "entity", "groups") == [("mid", "X,Y")]
    assert [e for (e,) in tuples(value.value_per_cost(lines, 10), "entity")] == ["top", "mid", "low"]
    assert value.value_per_cost(lines, 10, level="period", since=2001).count() == 0


def test_retention(make_lines):
    lines = make_lines(
        # k (3) larger than the roster; a leaves and comes back; b stays under the group's later code
        [("a", "A", 2000, "MON", 0, 3), ("b", "B", 2000, "MON", 0, 2), ("a", "A", 2001, "X", 0, 1),
         ("a", "A", 2002, "MON", 0, 1), ("b", "B", 2002, "WSN", 0, 1), ("c", "C", 2000, "WSN", 0, 9), ("c", "C", 2003, "WSN", 0, 1)]
    )
    assert tuples(cohorts.retention(lines, "MON", 3, 2, 2000, 2004), "from_period", "to_period", "retained") == [
        (2000, 2002, 1), (2002, 2004, 0),
    ]
    got = tuples(cohorts.average_retention(lines, 3, 2, 2000, 2003, aliases={"MON": "WSN"}), "grp", "average_retained")
    assert got == [("WSN", 2.0)]
    assert cohorts.average_retention(lines, 3, 2, 2000, 2003, exclude=["WSN"]).count() == 0


def test_relative_retention(make_lines):
    lines = make_lines(
        [("a", "A", 2019, "OAK", 0, 5), ("b", "B", 2019, "OAK", 0, 4), ("c", "C", 2019, "OAK", 0, 3),
         ("x", "X", 2019, "BOS", 0, 2), ("y", "Y", 2019, "BOS", 0, 2), ("z", "Z", 2019, "BOS", 0, 1),
         ("b", "B", 2022, "OAK", 0, 1), ("c", "C", 2022, "OAK", 0, 1), ("a", "A", 2022, "BOS", 0, 1)]
    )
    own = tuples(cohorts.relative_retention(lines, "OAK", 2019, "OAK", 2022), "entity")
    assert own == [("b",), ("c",)]
    assert tuples(cohorts.relative_retention(lines, "OAK", 2019, "OAK", 2022, "BOS"), "entity") == [("y",), ("z",)]
    assert len(tuples(cohorts.relative_retention(lines, "OAK", 2019, "OAK", 2019), "entity")) == 3


@pytest.fixture(scope="module")
def award_table(spark):
    return spark.createDataFrame(
        [("w", 2000, "CY", "ML", True), ("v", 2001, "CY", "AL", True), ("u", 2001, "CY", "NL", True), ("n", 2000, "GG", "AL", True),
         ("n", 2000, "CY", "AL", False)],
        "entity string, period int, award string, league string, winner boolean",
    )


def test_award_snubs(make_lines, award_table):
    def line(e, y, m, lg):
        return (e, e.upper(), y, "X", 1, m, 0, None, lg)

    lines = make_lines(
        [line("w", 2000, 5, "AL"), line("n", 2000, 7, "NL"), line("m", 2000, 4, "AL"),
         line("v", 2001, 3, "AL"), line("u", 2001, 2, "NL"), line("k", 2001, 4, "NL"), line("j", 2001, 9, "FL"),
         ("w", "Winner", 1999, "X", 1, None, 0, None, "AL")]
    )
    got = tuples(
        awards.award_snubs(lines, award_table, "CY", 10, since=1956, leagues=["AL", "NL"]),
        "period", "league", "entity", "winner", "winner_name", "advantage",
    )
    # 2000: the winner stands for both leagues. 2001: v won too, so v is no snub against u; k is one against u only
    assert got == [(2000, "NL", "n", "w", "Winner", 2.0), (2001, "NL", "k", "u", "U", 2.0)]
    measured = lines.where("measure is not null")
    assert tuples(awards.award_snubs_anti(measured, award_table, "GG", 1), "entity") == [("j",)]
    assert tuples(awards.worst_winners(measured, award_table, "GG", 5), "entity", "total") == [("n", 7.0)]


def test_snubs_two_source(make_lines, award_table):
    lines = make_lines(
        [("v", "V", 2001, "X", 0, 2, 0, None, "AL"), ("v", "V2", 2001, "X", 1, 1, 0, None, "AL"),
         ("k", "K", 2001, "X", 0, 1, 0, None, "AL"), ("k", "K", 2001, "X", 0, 0.5, 0, None, "NL"), ("k", "K", 2001, "X", 1, 4, 0, None, "NL"),
         # only in the second source: no league, so no snub
         ("p", "P", 2001, "X", 1, 9, 0, None, "AL")]
    )
    won = award_table.where("entity = 'v'")
    got = tuples(
        awards.award_snubs_two_source(lines, won, "CY", 10, since=1922, leagues=["AL", "NL"]),
        "entity", "league", "total", "winner", "winner_name", "winner_total",
    )
    assert got == [("k", "AL", 5.5, "v", "V", 3.0)]


def test_group_award_average_pairs(spark, make_lines):
    stars = spark.createDataFrame(
        [("a", 2000, "AS", None, True), ("a", 2000, "AS", None, True), ("b", 2000, "AS", None, True)],
        "entity string, period int, award string, league string, winner boolean",
    )
    lines = make_lines(
        [("a", "A", 2000, "X", 0, 1), ("a", "A", 2000, "Y", 0, 2), ("a", "A", 2000, "X", 1, 10), ("a", "A", 2000, "Z", 1, 20),
         ("b", "B", 2000, "Z", 1, 5), ("b", "B", 2000, "X", 1, 7)]
    )
    import itertools

    pairs = []
    for who, copies, first, second in (("a", 2, [("X", 1), ("Y", 2)], [("X", 10), ("Z", 20)]), ("b", 1, [], [("Z", 5), ("X", 7)])):
        for (g0, m0), (g1, m1) in itertools.product(first or [(None, 0)], second):
            pairs += [(g0 or g1, m0 + m1)] * copies
    expect = {}
    for g, m in pairs:
        expect.setdefault(g, []).append(m)
    expect = {g: (len(v), sum(v) / len(v)) for g, v in expect.items() if len(v) > 1}
    got = awards.group_award_average(lines, stars, "AS", since=1933, pair_sources=True)
    assert {r[0]: r[1:] for r in tuples(got, "group_name", "times", "average")} == expect
    plain = awards.group_award_average(lines, stars, "AS", since=1933)
    assert {r[0]: r[1:] for r in tuples(plain, "group_name", "times", "average")} == {
        "X": (3, (11 * 2 + 7) / 3), "Y": (2, 2.0), "Z": (3, (20 * 2 + 5) / 3),
    }


def test_active(make_lines):
    lines = make_lines(
        [("a", "A", 2000, "X", 0, 4), ("a", "A", 2001, "X", 0, 2), ("b", "B", 1999, "X", 0, 9),
         ("c", "C", 2001, "X", 0, 1), ("c", "C", 2001, "Y", 0, 1), ("c", "C", 2001, "X", 1, 3), ("c", "Cz", 2001, "X", 1, None),
         # the newest season of source 0 has no measure; still, it sets what active means
         ("d", "D", 2001, "X", 0, None)]
    )
    assert tuples(active.active_total(lines, 5), "entity", "name", "total") == [("a", "A", 6.0), ("c", "Cz", 5.0)]
    assert tuples(active.active_average(lines, 2, 5), "entity", "average") == [("a", 3.0)]
    assert tuples(active.active_low_total(lines, 2, 5), "entity", "periods") == [("c", 2), ("a", 2)]
    assert tuples(active.active_low_total(lines, 2, 5, count_per_source=False), "entity") == [("a",)]
    assert tuples(active.active_low_average(lines, 1, 5), "entity", "total") == [("a", 6.0), ("c", 5.0)]
    # 2 lines x 2 lines: (1 + 1) * 2 + 3 * 2
    assert tuples(active.active_low_average(lines, 1, 5, pair_lines=True), "entity", "total") == [("a", 6.0), ("c", 10.0)]


def test_categories(make_lines):
    rows = [("a", "A", y, "X", 0, 1, 0, "SS,2B") for y in (1, 2, 3)] + [("a", "A", 4, "X", 0, -8, 0, "C")]
    rows += [("b", "B", y, "X", 0, -2, 0, "SS") for y in (1, 2, 3)] + [("c", "C", y, "X", 0, -2, 0, "SS") for y in (1, 2, 3)]
    rows += [("d", "D", y, "X", 0, 3, 0, "C") for y in (1, 2)] + [("e", "E", 1, "X", 0, 50, 0, None)]
    lines = make_lines(rows)
    low = tuples(ranking.extreme_by_primary_category(lines, 2, ["C", "SS"]), "category", "entity", "periods", "total")
    assert low == [("C", "d", 2, 6.0), ("SS", "b", 3, -6.0), ("SS", "c", 3, -6.0)]
    best = tuples(ranking.extreme_average_by_category(lines, 2, ["C", "SS"]), "category", "entity", "average")
    assert best == [("C", "d", 3.0), ("SS", "a", 1.0)]
    worst = tuples(ranking.extreme_average_by_category(lines, 2, ["SS", "C"], worst=True), "category", "entity")
    assert worst == [("SS", "b"), ("C", "d")]
    top = tuples(leaders.average_measure(lines, 2, 1), "entity", "categories")
    assert top == [("d", "C")]
    assert tuples(leaders.measure_leaders(lines, 1, level="line"), "entity", "measure") == [("e", 50.0)]


def test_average_retention_counts_the_best_of_renamed_and_own_codes(make_lines):
    """Against a plain count, with an alias beside the own code, groups without a name, and more members than are kept."""
    rng = random.Random(21)
    codes = ["MON", "WSN", "BOS", None]
    rows = [(f"e{rng.randint(0, 40)}", "n", rng.randint(2000, 2008), rng.choice(codes), rng.randint(0, 1), rng.randint(-9, 30)) for _ in range(1500)]
    k, gap, lo, hi, aliases = 3, 2, 2001, 2007, {"MON": "WSN"}
    season, first, member, own, seen = defaultdict(int), {}, set(), set(), defaultdict(int)
    for e, _, period, code, source, measure in rows:
        seen[source] += 1
        season[e, period] += measure
        first[e] = min(first.get(e, (2, 0)), (source, seen[source]))
        member.add((e, period, aliases.get(code, code)))
        own.add((code, period))
    wanted = {}
    for g in {g for _, _, g in member}:
        mine = [p for c, p in own if c == g and (c not in aliases)]
        kept = []
        for p in range(lo, hi - gap + 1):
            best = sorted((e for e, q, h in member if (q, h) == (p, g)), key=lambda e: (-season[e, p], first[e]))[:k]
            kept += [sum((e, p + gap, g) in member for e in best)] if best else []
        if g is not None and mine and min(mine) <= lo and max(mine) >= hi and kept:
            wanted[g] = sum(kept) / len(kept)
    got = dict(tuples(cohorts.average_retention(make_lines(rows), k, gap, lo, hi, aliases=aliases), "grp", "average_retained"))
    assert wanted and set(got) == set(wanted) and all(abs(got[g] - wanted[g]) < 1e-9 for g in wanted)

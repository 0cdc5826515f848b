from pennant.operators import enrich


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_awards(spark):
    given = spark.createDataFrame(
        [("ruth", "MVP", 1923, "AL"), ("mays", "Gold Glove", 1957, "NL"), ("mays", "Gold Glove", 1957, "NL"),
         ("sub1", "TSN Guide MVP", 1930, "AL"), ("prim", "Most Valuable Player", 1931, "AL"), ("sub2", "TSN Guide MVP", 1931, "AL"),
         ("sub3", "TSN Guide MVP", 1931, None), ("new", "Rookie of the Year", 1950, "ML")],
        "entity string, award string, period int, league string",
    )
    stars = spark.createDataFrame([("ruth", 1933, "AL"), ("ruth", 1933, "AL")], "entity string, period int, league string")
    shares = spark.createDataFrame(
        [("PRIM", 1931, "Most Valuable Player", "AL", 80.0, 100.0, 8.0), ("other", 1931, "Most Valuable Player", "AL", 20.0, 100.0, 0.0),
         ("mays", 1957, "Gold Glove", "AL", 1.0, 0.0, None)],
        "entity string, period int, award string, league string, points_won double, points_max double, votes_first double",
    )
    got = set(rows(enrich.build_awards(given, shares, stars), "entity", "period", "award", "league", "winner", "vote_share"))
    assert got == {
        ("PRIM", 1931, "MVP", "AL", True, 0.8), ("other", 1931, "MVP", "AL", False, 0.2),
        # the ballot is in the other league: not a win there, and the win itself counts as balloted
        ("mays", 1957, "Gold Glove", "AL", False, None),
        ("ruth", 1923, "MVP", "AL", True, None), ("sub1", 1930, "MVP", "AL", True, None), ("sub3", 1931, "MVP", None, True, None),
        ("new", 1950, "ROY", "ML", True, None), ("ruth", 1933, "All-Star", "AL", True, None),
    }
    lists = dict((tuple(r[:2]), r[2]) for r in rows(enrich.award_lists(given, stars), "entity", "period", "awards"))
    assert lists[("ruth", 1933)] == "All-Star,All-Star" and lists[("mays", 1957)] == "Gold Glove,Gold Glove"
    assert ("sub2", 1931) not in lists and lists[("sub1", 1930)] == "MVP"


def test_ballots(spark):
    df = spark.createDataFrame(
        [("ruth", 1936, "215", "226", "Y", "BBWAA"), ("mays", 1979, "409", "432", "Y", "BBWAA"), ("x", 1940, "n/a", "10", "N", "V"), ("y", 1941, "1", "0", "N", "V")],
        "playerID string, yearID int, votes string, ballots string, inducted string, votedBy string",
    )
    out = enrich.build_ballots(df, "playerID", "yearID", "votes", "ballots", "inducted", "votedBy")
    pct = {r.entity: r.vote_pct for r in out.collect()}
    assert round(pct["ruth"], 4) == 95.1327 and round(pct["mays"], 4) == 94.6759
    assert pct["x"] is None and pct["y"] is None


def test_category_list_from_stints(spark):
    df = spark.createDataFrame(
        [("a", 2000, "SS", 60), ("a", 2000, "SS", 60), ("a", 2000, "2B", 37), ("a", 2000, "OF", 5), ("a", 2000, "C", 4), ("a", 2000, "PH", 900),
         ("a", 2000, "ZZ", 900), ("b", 2000, "PH", 3)],
        "entity string, period int, code string, games int",
    )
    # total is 166: 5 games are 3.01 %, 4 games are not enough
    assert rows(enrich.category_list(df), "entity", "categories") == [("a", "SS,SS,2B,OF")]


def test_category_list_from_events(spark):
    events = [("a", 2000, 6)] * 97 + [("a", 2000, 4)] * 3 + [("a", 2000, 11)] * 50 + [("b", 2000, 9), ("b", 2000, 3), ("c", 2000, 12)]
    df = spark.createDataFrame(events, "entity string, period int, code int")
    assert dict(rows(enrich.category_list_from_events(df), "entity", "categories")) == {"a": "SS,2B", "b": "1B,RF"}
    links = spark.createDataFrame([("a", "A-new")], "from_id string, to_id string")
    assert rows(enrich.via_crosswalk(enrich.category_list_from_events(df), links), "entity", "categories") == [("A-new", "SS,2B")]


def test_rates(spark):
    bat = {c: "1" for c in enrich.BATTING_COUNTS}
    table = [
        {"entity": "a", **bat, "AB": "10", "H": "3"}, {"entity": "a", **bat, "AB": "x", "H": "2"},
        {"entity": "zero", **bat, "AB": "0"}, {"entity": "nosf", **bat, "SF": None},
    ]
    schema = "entity string, " + ", ".join(f"`{c}` string" for c in enrich.BATTING_COUNTS)
    df = spark.createDataFrame([tuple(r[c] for c in ["entity", *enrich.BATTING_COUNTS]) for r in table], schema)
    out = {r.entity: r for r in enrich.batting_rates(enrich.counting_totals(df, ["entity"], enrich.BATTING_COUNTS)).collect()}
    assert out["a"].AVG == 0.5 and out["a"].OBP == 9 / 16 and out["a"].SLG == (5 + 2 + 4 + 6) / 10
    assert out["zero"].AVG is None and out["zero"].OBP == 1.0
    assert out["nosf"].SF is None and out["nosf"].OBP is None and out["nosf"].AVG == 1.0

    pit = {c: "1" for c in enrich.PITCHING_COUNTS}
    table = [{"entity": "p", **pit, "IPouts": "10", "ER": "2"}, {"entity": "none", **pit, "IPouts": "0"}]
    schema = "entity string, " + ", ".join(f"{c} string" for c in enrich.PITCHING_COUNTS)
    df = spark.createDataFrame([tuple(r[c] for c in ["entity", *enrich.PITCHING_COUNTS]) for r in table], schema)
    out = {r.entity: r for r in enrich.pitching_rates(enrich.counting_totals(df, ["entity"], enrich.PITCHING_COUNTS)).collect()}
    assert out["p"].IP == 10 / 3 and abs(out["p"].ERA - 5.4) < 1e-12 and out["none"].ERA is None and out["p"].lh_GS == 1


def test_enrich_lines(spark):
    bat = spark.createDataFrame(
        [("P1", 2000, 1, "NL", 10), ("P1", 2000, 2, "NL", 10), ("p2", 1980, 1, "AL", 5), ("p3", 2023, 1, "AL", 5), ("p4", 2000, 1, "AL", 5)],
        "player_ID string, year_ID int, stint_ID int, lg_ID string, G int",
    )
    pitch = spark.createDataFrame(
        [("p1", 2000, 1, "NL", 10, 9), ("p1", 2000, 2, "NL", 30, 0), ("p2", 1980, 1, "AL", 9, 9), ("p3", 2023, 1, "AL", 9, 9)],
        "player_ID string, year_ID int, stint_ID int, lg_ID string, G int, GS int",
    )
    events = spark.createDataFrame([("P4", 2000, "SS")], "entity string, period int, categories string")
    awards = spark.createDataFrame([("p1", 2000, "MVP")], "entity string, period int, awards string")
    out = enrich.enrich_a(bat, events=events, pitchers=pitch, awards=awards)
    got = {(r.player_ID, r.stint_ID): (r.position, r.positions_lahman, r.awards) for r in out.collect()}
    # p1: 9 starts in 40 games over both stints; p2: designated-hitter league; p3: after the rule ended
    assert got == {
        ("P1", 1): ("RP", None, "MVP"), ("P1", 2): ("RP", None, None), ("p2", 1): (None, None, None),
        ("p3", 1): ("SP", None, None), ("p4", 1): ("SS", None, None),
    }
    assert enrich.enrich_a(bat).columns == bat.columns
    out = enrich.enrich_b(pitch, events=events, awards=awards)
    assert {(r.player_ID, r.stint_ID): (r.positions, r.awards) for r in out.collect()} == {
        ("p1", 1): ("SP", "MVP"), ("p1", 2): ("RP", None), ("p2", 1): ("SP", None), ("p3", 1): ("SP", None),
    }
    assert enrich.enrich_b(pitch).columns == pitch.columns

"""The table build: raw CSV files in, enriched Parquet tables out.

Only the two line files are required. Every other input that is missing leaves its table and its
columns out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.operators import enrich
from pennant.plans.catalog import Book
from pennant.sources import read_crosswalk, read_csv, read_game_log, write_bucketed, write_table

# --- Fixed values: column names of the public files ---------------------------------------------

ID, YEAR = "playerID", "yearID"
AWARD_COLUMNS = f"{ID} string, awardID string, {YEAR} int, lgID string"
SHARE_COLUMNS = f"{ID} string, awardID string, {YEAR} int, lgID string, pointsWon double, pointsMax double, votesFirst double"
SELECTION_COLUMNS = f"{ID} string, {YEAR} int, lgID string"
BALLOT_COLUMNS = f"{ID} string, {YEAR} int, votedBy string, ballots string, votes string, inducted string"
FIELDING_COLUMNS = f"{ID} string, {YEAR} int, POS string, G int"
TEAM_COLUMNS = "team_id string, team_name string, lg_id string"
REGISTER_FROM, REGISTER_TO = "key_retro", "key_bbref"


@dataclass(frozen=True)
class Inputs:
    """Paths of the raw files; ``None`` means not there. Lists of paths or globs are fine."""

    bat_lines: str
    pitch_lines: str
    batting: str | None = None
    pitching: str | None = None
    fielding: str | None = None
    awards: str | None = None
    award_shares: str | None = None
    selections: str | None = None
    ballots: str | None = None
    teams: str | None = None
    game_logs: str | None = None
    register: str | None = None


def _keyed(df: DataFrame, **names: str) -> DataFrame:
    """(entity, period) from the player and year columns, other columns renamed."""
    rest = {v: k for k, v in names.items()}
    return df.select(
        F.col(ID).alias("entity"), F.col(YEAR).alias("period"),
        *[F.col(f"`{c}`").alias(rest.get(c, c)) for c in df.columns if c not in (ID, YEAR)],
    )


def _counts(spark: SparkSession, path: str | None, counts: list[str], rates) -> DataFrame | None:
    if path is None:
        return None
    schema = f"{ID} string, {YEAR} int, " + ", ".join(f"`{c}` string" for c in counts)
    return rates(enrich.counting_totals(_keyed(read_csv(spark, path, schema)), ["entity", "period"], counts))


def build_tables(spark: SparkSession, inputs: Inputs, out: str) -> list[str]:
    """Write every table its inputs allow under ``out``; returns the table names."""
    written: list[str] = []

    def put(name: str, df: DataFrame) -> DataFrame:
        path = write_table(df, f"{out}/{name}")
        written.append(name)
        return spark.read.parquet(path)

    events = stints = award_lists = None
    if inputs.game_logs and inputs.register:
        logs = read_game_log(spark, inputs.game_logs).withColumnRenamed("id", "entity")
        lists = put("retrosheet_positions", enrich.category_list_from_events(logs))
        links = put("id_crosswalk", read_crosswalk(spark, inputs.register, REGISTER_FROM, REGISTER_TO).distinct())
        events = enrich.via_crosswalk(lists, links)
    if inputs.fielding:
        rows = _keyed(read_csv(spark, inputs.fielding, FIELDING_COLUMNS, null_value=None), code="POS", games="G")
        stints = put("lahman_positions", enrich.category_list(rows))
    if inputs.awards and inputs.selections:
        given = _keyed(read_csv(spark, inputs.awards, AWARD_COLUMNS), award="awardID", league="lgID")
        chosen = _keyed(read_csv(spark, inputs.selections, SELECTION_COLUMNS), league="lgID")
        award_lists = enrich.award_lists(given, chosen)
        if inputs.award_shares:
            shares = _keyed(
                read_csv(spark, inputs.award_shares, SHARE_COLUMNS),
                award="awardID", league="lgID", points_won="pointsWon", points_max="pointsMax", votes_first="votesFirst",
            )
            ballots = enrich.build_awards(given, shares, chosen)
            put(
                "awards",
                ballots.withColumnsRenamed({"entity": "player_ID", "period": "year_ID", "league": "lg_ID"}),
            )
    if inputs.ballots:
        raw = read_csv(spark, inputs.ballots, BALLOT_COLUMNS)
        ballots = enrich.build_ballots(raw, ID, YEAR, "votes", "ballots", "inducted", "votedBy")
        put("hall_of_fame", ballots.withColumnsRenamed({"entity": "player_id", "period": "year_id"}))
    if inputs.teams:
        dim = enrich.build_groups(read_csv(spark, inputs.teams, TEAM_COLUMNS, null_value=None), "team_id", "team_name", "lg_id")
        put("teams", dim.withColumnsRenamed({"group_id": "team_id", "group_name": "team_name", "league": "lg_id"}))

    batting = _counts(spark, inputs.batting, enrich.BATTING_COUNTS, enrich.batting_rates)
    pitching = _counts(spark, inputs.pitching, enrich.PITCHING_COUNTS, enrich.pitching_rates)
    bat = read_csv(spark, inputs.bat_lines, line_no="line_no")
    pitch = read_csv(spark, inputs.pitch_lines, line_no="line_no")
    have_positions = events is not None
    put(
        "war_daily_bat",
        enrich.enrich_a(
            bat, events=events, stints=stints if have_positions else None, pitchers=pitch if have_positions else None,
            stats=batting, awards=award_lists,
        ),
    )
    put("war_daily_pitch", enrich.enrich_b(pitch, events=events, stats=pitching, awards=award_lists))
    rolled = Book.open(spark, out, awards=False, teams=False, stints=False).roll_up()
    write_bucketed(rolled, f"{out}/stints", "entity", "period")
    return [*written, "stints"]

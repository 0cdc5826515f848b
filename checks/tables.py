"""Role bindings: the star schema read as lines, categories, awards and raw enrichment inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.operators.enrich import category_list_from_events
from pennant.sources import Roles, as_lines, read_facts
from pennant.sources.checkpoints import cut_lineage

# Cents taken off every line, so that negative totals occur.
LINE_OFFSET = 4_000_000
LEAGUES = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
ROLES = Roles("entity", "name", "period", "grp", "league", "measure", "cost", "category", "line_no")


# Given schemas: without them every read starts with a job that opens a file footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with all roles. Unused columns and joins' columns are pruned per query."""
    # Dimensions one by one, each a plain scan whose size Spark knows: small ones are broadcast, large
    # ones are not. Orders get their customer's name first, so that lines are moved by order only once;
    # neither side of that join passes for small, so the fact table is never the one broadcast.
    line = (
        read_facts(spark, f"{sf_dir}/lineitem.parquet", schema=SCHEMAS["lineitem"])
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    buyer = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "c_name", "o_orderdate", "o_totalprice", "o_orderpriority")
    )
    cents = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100 + 0.5)
    return (
        line.join(buyer, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("entity"),
            F.col("c_name").alias("name"),
            F.year("o_orderdate").alias("period"),
            F.col("n_name").alias("grp"),
            F.col("r_name").alias("league"),
            F.when(F.col("l_linestatus") == "O", 0).otherwise(1).alias("source"),
            "line_no",
            (cents - LINE_OFFSET).alias("measure"),
            (F.col("l_quantity").cast("long") - 25).alias("measure2"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.floor(F.col("o_totalprice") * 100 + 0.5)).alias("cost"),
            F.col("o_orderpriority").alias("priority"),
            F.col("l_partkey").alias("part"),
            F.col("l_linenumber").alias("stint"),
            F.col("l_quantity").cast("int").alias("games"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
        )
    )


def lines(spark: SparkSession, sf_dir: str, leagues: tuple[str, ...] | None = LEAGUES, where: Column | None = None) -> DataFrame:
    base = star(spark, sf_dir).withColumn("category", F.lit(None).cast("string"))
    return as_lines(base, ROLES, F.col("source"), leagues=leagues, where=where)


def flagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines; those of the listed leagues count."""
    base = star(spark, sf_dir).withColumn("category", F.lit(None).cast("string"))
    return as_lines(base, ROLES, F.col("source"), leagues=LEAGUES, flag=True)


def events(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """(entity, period, code) per line; the code is the part's brand number, 1 to 25. ``base``: the star, if it is stored."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"), F.substring("p_brand", 7, 9).cast("int").alias("code")
    )
    return (base or star(spark, sf_dir)).join(part, "part").select("entity", "period", "code")


def category_lines(
    spark: SparkSession,
    sf_dir: str,
    measure: str = "measure",
    source: int | None = 0,
    single_lines: bool = False,
) -> DataFrame:
    """Lines with the category list of their (entity, period); some lists are missing.

    Order lines are added up to one line per (entity, period, group) stint before they meet the lists,
    so that a hot season is a handful of rows in that join; ``single_lines`` keeps them apart.
    """
    lists = category_list_from_events(events(spark, sf_dir)).withColumnRenamed("categories", "category")
    base = star(spark, sf_dir)
    if source is not None:
        base = base.where(F.col("source") == source)
    if not single_lines:
        base = base.groupBy("entity", "name", "period", "grp", "league", "source").agg(
            F.sum(measure).alias(measure), F.sum("cost").alias("cost"), F.min("line_no").alias("line_no")
        )
    joined = base.join(lists, ["entity", "period"], "left")
    roles = Roles("entity", "name", "period", "grp", "league", measure, "cost", "category", "line_no")
    return as_lines(joined, roles, F.col("source"))


def _most(df: DataFrame, keys: list[str]) -> DataFrame:
    """Entity with most rows per key; ties go to the lowest entity."""
    counts = df.groupBy(*keys, "entity").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by("entity", F.struct(F.col("n"), -F.col("entity")))
    return counts.groupBy(*keys).agg(best.alias("entity"))


def awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards from order priorities. One prize is given for all leagues together before 1998."""
    base = star(spark, sf_dir).select("entity", "period", "league", "source", "priority")
    urgent = F.col("priority") == "1-URGENT"
    high = (F.col("priority") == "2-HIGH") & (F.col("source") == 1)
    medium = (F.col("priority") == "3-MEDIUM") & (F.col("source") == 0)
    together = high & (F.col("period") < 1998)
    prizes = base.where(urgent | high).select(
        "entity", "period", F.when(urgent, "MVP").otherwise("Cy Young Award").alias("award"),
        F.when(together, "ML").otherwise(F.col("league")).alias("league"),
    )
    honours = (
        base.where(urgent | medium)
        .groupBy("entity", "period", F.when(urgent, "All-Star").otherwise("Gold Glove").alias("award"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= F.when(F.col("award") == "All-Star", 3).otherwise(2))
        .select("entity", "period", "award", F.lit(None).cast("string").alias("league"))
    )
    best = _most(prizes, ["award", "league", "period"]).select("entity", "period", "award", "league")
    # stands in for a stored table, so it is worked out once
    return cut_lineage(best.unionByName(honours).withColumn("winner", F.lit(True)))


# --- Raw inputs of the enrichment jobs; ``base`` is the star, if it is stored --------------------


# The customer with most orders of a priority, per league and period, wins this.
PRIZES = {
    "1-URGENT": "Most Valuable Player", "2-HIGH": "TSN Guide MVP", "3-MEDIUM": "Rookie of the Year",
    "4-NOT SPECIFIED": "Gold Glove",
}


def raw_awards(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(awards, shares, selections) as the award build reads them; one league is null."""
    base = base or star(spark, sf_dir)
    league = F.when(F.col("league") != "EUROPE", F.col("league"))
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), "c_name")

    award = F.create_map(*[F.lit(x) for kv in PRIZES.items() for x in kv])[F.col("priority")]
    prizes = base.where((F.col("priority") != "5-LOW") & ((F.col("priority") != "1-URGENT") | (F.col("period") >= 1997)))
    given = (
        _most(prizes, ["priority", "league", "period"])
        .join(names, "entity")
        .select(F.col("c_name").alias("entity"), award.alias("award"), "period", league.alias("league"))
    )
    given = cut_lineage(given)  # stands in for a stored table
    urgent = F.col("priority") == "1-URGENT"
    shares = (
        base.groupBy("entity", "name", "period", "league")
        .agg(
            F.count(F.when(urgent, 1)).alias("points_won"),
            F.count(F.when(F.col("source") == 0, 1)).alias("points_max"),
            F.count(F.when(urgent & (F.col("source") == 0), 1)).alias("votes_first"),
        )
        .where(F.col("points_won") >= 2)
        .select(
            F.lower("name").alias("entity"), "period", F.lit("Most Valuable Player").alias("award"),
            league.alias("league"), "points_won", "points_max", "votes_first",
        )
    )
    chosen = (
        base.where(urgent)
        .groupBy("entity", "name", "period")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= 3)
        .select(F.col("name").alias("entity"), "period", F.lit("ASIA").alias("league"))
    )
    return given, shares, chosen


def raw_lines(spark: SparkSession, sf_dir: str, source: int, base: DataFrame | None = None) -> DataFrame:
    """Raw lines with the key columns of the enrichment jobs; ids differ in case between tables."""
    size = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), "p_size")
    base = (base or star(spark, sf_dir)).where(F.col("source") == source).join(size, "part")
    return base.select(
        (F.upper("name") if source == 0 else F.col("name")).alias("player_ID"),
        F.col("period").alias("year_ID"), F.col("stint").alias("stint_ID"), F.col("league").alias("lg_ID"),
        F.col("games").alias("G"), F.col("p_size").alias("GS"), "line_no",
    )


# Part types read as fielding codes: one is no fielding position, one is unknown.
TYPE_CODES = {"ECONOMY": "1B", "PROMO": "SS", "STANDARD": "OF", "SMALL": "PH", "MEDIUM": "C", "LARGE": "XX"}


def raw_fielding(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    kind = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), "p_type")
    codes = F.create_map(*[F.lit(x) for kv in TYPE_CODES.items() for x in kv])
    return (base or star(spark, sf_dir)).join(kind, "part").select(
        F.col("name").alias("entity"), "period", codes[F.col("p_type")].alias("code"), "games"
    )


def raw_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id register; customers in debt have no first id."""
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(F.concat(F.lit("r"), F.col("c_custkey"))).alias("key_a"),
        F.col("c_name").alias("key_b"),
    )


def raw_batting(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Counting stats as text; some fields are no numbers, some are null."""
    base = base or star(spark, sf_dir)
    q = F.col("games")
    text = {
        "AB": F.when(F.col("stint") == 7, F.lit("x")).otherwise((q * 4).cast("string")),
        "R": (q % 7).cast("string"), "H": q.cast("string"), "2B": (q % 5).cast("string"), "3B": (q % 3).cast("string"),
        "HR": (q % 4).cast("string"), "RBI": (q % 11).cast("string"), "SB": (q % 6).cast("string"),
        "CS": (q % 2).cast("string"), "BB": (q % 9).cast("string"), "SO": (q % 13).cast("string"),
        "HBP": F.when(F.col("stint") < 4, (q % 2).cast("string")), "SF": F.when(F.col("stint") > 1, (q % 3).cast("string")),
        "GIDP": (q % 8).cast("string"),
    }
    return base.select(F.col("name").alias("entity"), "period", *[c.alias(k) for k, c in text.items()])


def raw_pitching(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    base = base or star(spark, sf_dir)
    q = F.col("games")
    text = {
        "W": q % 5, "L": q % 4, "GS": q % 9, "CG": q % 2, "SHO": q % 3, "SV": q % 6, "IPouts": F.when(q > 10, q * 3 + q % 3).otherwise(0),
        "H": q, "ER": q % 10, "HR": q % 4, "BB": q % 8, "SO": q % 12, "WP": q % 2, "HBP": q % 3, "BK": q % 2, "BFP": q * 4,
    }
    return base.select(F.col("name").alias("entity"), "period", *[c.cast("string").alias(k) for k, c in text.items()])

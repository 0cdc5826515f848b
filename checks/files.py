"""Readers and sinks on files that Spark writes from the given tables, in the folder the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from pennant.plans.catalog import Book, run_report
from pennant.plans.season_tables import Inputs, build_tables
from pennant.sources import lines_from_csv, read_crosswalk, read_csv, read_game_log, write_table
from pennant.sources.checkpoints import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that goes when the application ends."""
    ensure_checkpoint_dir(spark)
    named = spark.sparkContext.getCheckpointDir()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{named}/{name}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def stored_star(s: SparkSession, d: str) -> DataFrame:
    """The order lines as a stored table, for jobs whose raw inputs are all made of them: joined and moved once."""
    lines = t.star(s, d).select("entity", "name", "period", "league", "source", "line_no", "priority", "part", "stint", "games")
    return s.read.schema(lines.schema).parquet(write_table(lines, scratch(s, "star")))


def _orders_csv(s: SparkSession, d: str) -> str:
    """Orders as CSV files in key order; one priority is written as the null text."""
    path = scratch(s, "orders-csv")
    rows = t.table(s, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day"), "o_custkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.concat(F.lit('a "b", '), F.col("o_orderstatus")).alias("note"),
    )
    rows.orderBy("o_orderkey").write.option("header", True).option("nullValue", "NULL").csv(path)
    return path


def csv_null_text(s: SparkSession, d: str) -> DataFrame:
    """By a schema that names columns in another order, one that is not there, and a type some text does not fit."""
    df = read_csv(s, _orders_csv(s, d), "o_orderpriority string, o_custkey int, missing double, note int, o_orderkey long")
    return df.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("customers"), F.max("o_orderkey").alias("last_key"),
        F.count("missing").alias("missing"), F.count("note").alias("notes"),
    )


def csv_inferred(s: SparkSession, d: str) -> DataFrame:
    df = read_csv(s, _orders_csv(s, d))
    types = dict(df.dtypes)
    kinds = F.lit(",".join(types[c] for c in ("o_orderkey", "o_day", "o_custkey", "note")))
    return df.groupBy("note").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("customers"), F.max("o_day").cast("string").alias("last_day")).withColumn("kinds", kinds)


def csv_plain_text(s: SparkSession, d: str) -> DataFrame:
    df = read_csv(s, _orders_csv(s, d), "o_custkey int, o_orderpriority string", null_value=None)
    return df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("customers"))


def csv_line_order(s: SparkSession, d: str) -> DataFrame:
    """The files hold the orders by key, so line order is key order over all of them."""
    df = read_csv(s, _orders_csv(s, d), "o_orderkey long, o_custkey long", line_no="line_no")
    return df.groupBy("o_custkey").agg(
        F.min_by("o_orderkey", "line_no").alias("first_key"), F.max_by("o_orderkey", "line_no").alias("last_key"), F.count(F.lit(1)).alias("n")
    )


def table_sink(s: SparkSession, d: str) -> DataFrame:
    """A table that is replaced by another one, in folders by a column."""
    path = scratch(s, "sink")
    orders = t.table(s, d, "orders")
    write_table(orders.select("o_orderkey"), path)
    write_table(orders.select("o_custkey", "o_totalprice", "o_orderstatus"), path, ["o_orderstatus"])
    return s.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("customers"), F.max("o_totalprice").alias("dearest"))


def game_log(s: SparkSession, d: str) -> DataFrame:
    """A record of 161 fields per order line: a starter in each line-up; some records are short or without a year."""
    li = t.table(s, d, "lineitem")
    quoted = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    number = F.col("l_linenumber")
    filled = {
        0: quoted(F.when(F.col("l_partkey") % 50 == 0, F.lit("none0101")).otherwise(F.date_format("l_shipdate", "yyyyMMdd"))),
        105: quoted(F.concat(F.lit("s"), F.col("l_suppkey"))), 106: F.lit('"Last, First"'), 107: number.cast("string"),
        132: quoted(F.when(number == 3, F.lit("0")).otherwise(F.concat(F.lit("p"), F.col("l_partkey") % 40))),
        134: F.when(number == 5, F.lit("x")).otherwise(F.col("l_quantity").cast("int").cast("string")),
    }
    fields = [filled.get(i, F.lit("")) for i in range(161)]
    short = F.col("l_partkey") % 31 == 0
    line = F.when(short, F.concat_ws(",", *fields[:120])).otherwise(F.concat_ws(",", *fields))
    path = scratch(s, "game-log")
    li.select(line).write.text(path)
    return read_game_log(s, path).groupBy("id", "period", "code").agg(F.count(F.lit(1)).alias("n"))


def register_shards(s: SparkSession, d: str) -> DataFrame:
    """Several files with one header; blank ids drop out."""
    path = scratch(s, "register")
    t.raw_register(s, d).withColumn("other", F.lit("x")).repartition(3).write.option("header", True).csv(path)
    return read_crosswalk(s, path, "key_a", "key_b")


def legacy_lines(s: SparkSession, d: str) -> DataFrame:
    """Lower-case headers, a constant season type, counted lines only."""
    raw = t.table(s, d, "nation").join(t.table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    raw = raw.select(F.col("n_name").alias("Team_ID"), F.col("r_name").alias("LG_ID"), F.when(F.col("n_nationkey") % 4 != 0, F.col("n_nationkey")).alias("WAR"))
    return lines_from_csv(raw, "WAR", "LG_ID", ["ASIA", "EUROPE"], "regular")


def book(s: SparkSession, d: str) -> Book:
    """The order lines as the two line files of the table build, in two leagues; tables built from them, and opened.

    A line's value is in ten thousandths, so that it is exact.
    """
    base = t.star(s, d)
    league = F.when(F.col("league") == "AMERICA", "AL").when(F.col("league") == "EUROPE", "NL").otherwise("FL")
    out = scratch(s, "season-tables")
    for source, name in enumerate(("bat", "pitch")):
        own = base.where(F.col("source") == source).select(
            F.col("name").alias("name_common"), F.col("entity").alias("player_ID"), F.col("period").alias("year_ID"), F.col("grp").alias("team_ID"),
            F.col("stint").alias("stint_ID"), league.alias("lg_ID"), F.col("games").alias("G"), F.lit(0).alias("GS"),
            F.when(F.col("measure") % 97 != 0, (F.col("measure") / 10000).cast("decimal(12,4)")).alias("WAR"), F.col("cost").alias("salary"), "line_no",
        )
        own.orderBy("line_no").drop("line_no").write.option("header", True).option("nullValue", "NULL").csv(f"{out}/raw/{name}")
    build_tables(s, Inputs(bat_lines=f"{out}/raw/bat", pitch_lines=f"{out}/raw/pitch"), f"{out}/tables")
    return Book.open(s, f"{out}/tables", awards=False, teams=False)


def report(name: str):
    return lambda s, d: run_report(book(s, d), name)


def only_the_line_files(s: SparkSession, d: str) -> DataFrame:
    """Tables that the line files alone allow."""
    b = book(s, d)
    lines = b.measured.groupBy("source", "league").agg(F.count(F.lit(1)).alias("n"), F.sum("measure").alias("total"))
    return lines.withColumn("columns", F.lit(",".join(sorted(set(b.bat.columns) & set(b.pitch.columns)))))


QUERIES = {
    "a2_csv_null_text": csv_null_text,
    "a2_csv_inferred": csv_inferred,
    "a3_csv_plain_text": csv_plain_text,
    "a4_table_sink": table_sink,
    "a5_game_log": game_log,
    "a6_register_shards": register_shards,
    "a7_csv_line_order": csv_line_order,
    "a9_only_the_line_files": only_the_line_files,
    "a10_report_career_leaders": report("career_leaders"),
    "a10_report_costly_careers_active": report("costly_careers_active"),
    "a10_report_best_rosters": report("best_rosters"),
    "a11_legacy_lines": legacy_lines,
}

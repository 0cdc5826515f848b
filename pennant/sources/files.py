"""Scans and sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pennant.sources.checkpoints import cut_lineage

# line number = file number * 2^32 + row in the file; it stays below 2^60 up to 2^28 files
ROWS_PER_FILE_BITS = 32
MOST_FILES = 1 << 28
# A listing of this many bytes is still sent to every task.
LISTING_BYTES = 64 << 20


def read_facts(
    spark: SparkSession, *paths: str, line_no: str | None = "line_no", schema: T.StructType | str | None = None
) -> DataFrame:
    """Parquet fact table, with a ``line_no`` that follows file name and row order.

    A given ``schema`` saves the job that reads it from a file footer.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*paths)
    return number_lines(df, line_no) if line_no else df


def listed_files(df: DataFrame) -> list[str]:
    """The files of a plain scan by name, spelled as the scan's own metadata spells them."""
    files = sorted(re.sub("^file:///", "file:/", f) for f in df.inputFiles())
    if len(files) > MOST_FILES:
        raise ValueError(f"more than {MOST_FILES} files")
    return files


def with_file_number(df: DataFrame, files: list[str], path: str, alias: str) -> DataFrame:
    """Add the place of the file named in column ``path`` among ``files``, from 0.

    The driver listed the files to plan the scan, so their order costs no job and no window: a single file is a
    constant, more are a local table of the listing's size, joined to the rows (and sent to every task while small).
    A file that is not listed is an error.
    """
    if len(files) <= 1:
        return df.withColumn(alias, F.lit(0).cast("long"))
    listing = df.sparkSession.createDataFrame(pa.table({path: files, alias: pa.array(range(len(files)), pa.int64())}))
    if sum(map(len, files)) <= LISTING_BYTES:
        listing = F.broadcast(listing)
    missing = F.raise_error(F.concat(F.lit("file was not listed: "), path)).cast("long")
    return df.join(listing, path, "left").withColumn(alias, F.coalesce(alias, missing))


def number_lines(df: DataFrame, alias: str = "line_no") -> DataFrame:
    """Add the position of each row within its source: by file name, then by row.

    ``df`` must be a plain Parquet scan. The number comes from the scan's own row index, so there is
    no sort, window or pass over the files. It keeps its value under pushed-down filters.
    """
    row = (F.col("_metadata.row_index") + 1).cast("long")
    tagged = df.select("*", row.alias("_row"), F.col("_metadata.file_path").alias("_path"))
    tagged = with_file_number(tagged, listed_files(df), "_path", "_file_no")
    return tagged.withColumn(alias, _line_number(F.col("_row"))).drop("_row", "_path", "_file_no")


def _line_number(row: Column) -> Column:
    """``row`` counts from 1 within the file ``_file_no``."""
    fits = row < (1 << ROWS_PER_FILE_BITS)
    return F.when(fits, F.shiftleft("_file_no", ROWS_PER_FILE_BITS) + row).otherwise(
        F.raise_error(F.lit("a file has too many rows")).cast("long")
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    null_value: str | None = "NULL",
    line_no: str | None = None,
) -> DataFrame:
    """CSV with a header; ``null_value`` text is read as null. Give a schema to skip the inference scan.

    With a schema, columns are still matched by header name: the file may have them in any order and
    may have more. Files that are read together must have one header; a file with another one is an error.
    ``line_no`` numbers the lines, over all files in the order of their names.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        raw = reader.csv(path)
        have = {c.lower(): c for c in raw.columns}
        df = raw.select(
            *[
                F.expr(f"try_cast(`{have[f.name.lower()]}` as {f.dataType.simpleString()})").alias(f.name)
                if f.name.lower() in have
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in want.fields
            ]
        )
    return number_text_lines(df, line_no) if line_no else df


def number_text_lines(df: DataFrame, alias: str = "line_no") -> DataFrame:
    """Line order for text: by file name, then by line, for one file or many of any sizes.

    ``df`` is a plain text or CSV scan. A text file has no row index, and its splits are read in an order of the
    planner's. So the rows are written once, each with its file's number, the offset of its split and a number that grows
    within the split; the splits' counts then give the rows before each split. One row per split is all that is moved: the
    lines stay where they are, and the splits are sent to every task (while the listing is, of whose files they are parts).
    """
    meta = {"_path": F.col("_metadata.file_path"), "_split": F.col("_metadata.file_block_start"), "_id": F.monotonically_increasing_id()}
    files = listed_files(df)
    rows = cut_lineage(with_file_number(df.withColumns(meta), files, "_path", "_file_no").drop("_path"))
    splits = rows.groupBy("_file_no", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("_file_no").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    if sum(map(len, files)) <= LISTING_BYTES:
        splits = F.broadcast(splits)
    found = rows.join(splits, ["_file_no", "_split"])
    row = F.col("_ahead") + F.col("_id") - F.col("_first") + 1
    return found.select(*df.columns, _line_number(row).alias(alias))


def unpivot_slots(
    df: DataFrame,
    keep: Sequence[str | Column],
    slots: Sequence[tuple[str | Column, str | Column]],
    id_alias: str = "id",
    code_alias: str = "code",
) -> DataFrame:
    """One row per filled (id, code) slot of a wide row. Blank or ``0`` ids and non-whole codes are dropped."""
    pair = [
        F.struct(
            F.trim((F.col(i) if isinstance(i, str) else i).cast("string")).alias(id_alias),
            F.trim((F.col(c) if isinstance(c, str) else c).cast("string")).try_cast("int").alias(code_alias),
        )
        for i, c in slots
    ]
    long = df.select(*keep, F.explode(F.array(*pair)).alias("_slot"))
    filled = (F.col(f"_slot.{id_alias}") != "") & (F.col(f"_slot.{id_alias}") != "0")
    return long.where(filled & F.col(f"_slot.{code_alias}").isNotNull()).select(
        *[c for c in long.columns if c != "_slot"], "_slot.*"
    )


# Fixed values of the game-log format: at least 160 fields, two line-ups of nine starters, each
# starter three fields wide (id, name, position), the first at field 105, the second at field 132.
GAME_LOG_FIELDS = 160
LINEUP_STARTS = (105, 132)
SLOTS_PER_LINEUP = 9
FIELDS_PER_SLOT = 3


def read_game_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Starters of a headerless game log as (id, period, code) rows. Short records are dropped."""
    names = [f"f{i}" for i in range(GAME_LOG_FIELDS)]
    line = F.col("value")
    # commas outside quotes divide the fields; longer records are cut to the fields that are named
    fields = F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ",", -1))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    games = spark.read.text(path).where(fields >= GAME_LOG_FIELDS).select(F.from_csv(line, schema.simpleString()[7:-1].replace(":", " ")).alias("game")).select("game.*")
    period = F.substring(F.trim("f0"), 1, 4).try_cast("int")
    slots = [
        (names[start + FIELDS_PER_SLOT * i], names[start + FIELDS_PER_SLOT * i + 2])
        for start in LINEUP_STARTS
        for i in range(SLOTS_PER_LINEUP)
    ]
    games = games.withColumn("period", period).where(F.col("period").isNotNull())
    return unpivot_slots(games, ["period"], slots).select("id", "period", "code")


def read_crosswalk(spark: SparkSession, path: str | list[str], from_column: str, to_column: str) -> DataFrame:
    """Two id columns of a sharded register, by header name; rows with a blank id are dropped.

    Shards whose headers differ are an error, never read by position.
    """
    return crosswalk(spark.read.option("header", True).option("enforceSchema", False).csv(path), from_column, to_column)


def crosswalk(df: DataFrame, from_column: str, to_column: str) -> DataFrame:
    ids = df.select(
        F.trim(F.col(from_column).cast("string")).alias("from_id"), F.trim(F.col(to_column).cast("string")).alias("to_id")
    )
    return ids.where((F.col("from_id") != "") & (F.col("to_id") != ""))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace the Parquet table at ``path``."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path

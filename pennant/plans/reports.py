"""Ranked result sets and their text form."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pennant.functions import padded
from pennant.sources.checkpoints import cut_lineage

# monotonically_increasing_id keeps the partition above this bit and the row within it below
_ROW_BITS = 33


@dataclass(frozen=True)
class Field:
    """One printed column. A field without a source column holds the rank label."""

    header: str
    width: int
    align: str
    column: str | None = None


@dataclass(frozen=True)
class Report:
    name: str
    title: str
    layout: Sequence[Field]
    build: Callable[[object], DataFrame]


def ranked(df: DataFrame) -> DataFrame:
    """Add ``rank`` (1, 2, ...) in the frame's own sort order.

    A sorted frame has its rows in partition order, so the rank is the row's place in its partition
    plus the sizes of the partitions before it. The sorted rows are written once and then numbered.
    """
    tagged = cut_lineage(df.withColumn("_id", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_part", F.shiftright("_id", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tagged.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    row = F.col("_id") - F.shiftleft(F.col("_part"), _ROW_BITS)
    return tagged.join(starts, "_part").withColumn("rank", F.col("_start") + row + 1).drop("_id", "_part", "_start")


def labelled(df: DataFrame, layout: Sequence[Field]) -> DataFrame:
    """The declared columns as text, nulls as empty text, with ``rank`` and the ``#n:`` label."""
    label = F.concat(F.lit("#"), F.col("rank").cast("string"), F.lit(":"))
    columns = [
        (label if f.column is None else F.coalesce(F.col(f"`{f.column}`").cast("string"), F.lit(""))).alias(f"c{i}")
        for i, f in enumerate(layout)
    ]
    return ranked(df).select("rank", *columns)


def text_lines(rows: DataFrame, title: str, layout: Sequence[Field]) -> DataFrame:
    """(rank, line): title, row count, blank line and header at ranks -3 to 0, then one line per row."""
    def pad(values):
        return F.rtrim(F.concat_ws(" ", *[padded(v, f.width, f.align) for v, f in zip(values, layout)]))

    body = rows.select("rank", pad([F.col(f"c{i}") for i in range(len(layout))]).alias("line"))
    header = pad([F.lit(f.header) for f in layout])
    head = rows.agg(F.count(F.lit(1)).alias("n")).select(
        F.explode(
            F.array(
                F.struct(F.lit(-3).cast("long").alias("rank"), F.lit(title).alias("line")),
                F.struct(F.lit(-2).cast("long").alias("rank"), F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("line")),
                F.struct(F.lit(-1).cast("long").alias("rank"), F.lit("").alias("line")),
                F.struct(F.lit(0).cast("long").alias("rank"), header.alias("line")),
            )
        ).alias("h")
    )
    return head.select("h.*").unionByName(body)


def write_report(df: DataFrame, report: Report, out: str) -> None:
    """Write ``<out>/<name>/table`` (Parquet, with rank) and ``<out>/<name>/text`` (padded lines, in order)."""
    table = f"{out}/{report.name}/table"
    labelled(df, report.layout).write.mode("overwrite").parquet(table)
    rows = df.sparkSession.read.parquet(table)
    lines = text_lines(rows, report.title, report.layout).orderBy("rank")
    lines.select("line").write.mode("overwrite").text(f"{out}/{report.name}/text")


class Finished:
    """Notes of the reports that are whole, in the folder they are written to."""

    def __init__(self, spark: SparkSession, out: str, version: str) -> None:
        jvm = spark._jvm
        self._path, self.out, self.version = jvm.org.apache.hadoop.fs.Path, out, version
        self.system = self._path(out).getFileSystem(spark._jsc.hadoopConfiguration())

    def _note(self, name: str):
        return self._path(f"{self.out}/_finished/{name}.{self.version}")

    def holds(self, name: str) -> bool:
        """Noted for these tables, and both of its outputs were written to the end."""
        written = [self._path(f"{self.out}/{name}/{part}/_SUCCESS") for part in ("table", "text")]
        return all(self.system.exists(p) for p in [self._note(name), *written])

    def add(self, name: str) -> None:
        self.system.create(self._note(name), True).close()

    def remove(self, name: str) -> None:
        """Before a report is written: whatever is there is no longer whole."""
        self.system.delete(self._note(name), False)

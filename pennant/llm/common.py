"""Shared folder, scratch tables, row names and linked components."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; a cluster needs no copy of its own."""
    sc = spark.sparkContext
    if not any(os.path.basename(f) == "pennant-code.zip" for f in sc.listFiles):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        at = os.path.join(tempfile.mkdtemp(prefix="pennant-code-"), "pennant-code")  # read by the driver alone
        sc.addPyFile(shutil.make_archive(at, "zip", root, "pennant"))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; one of its own only where none is named on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="pennant-scratch-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


class Space:
    """Scratch tables of one operator call. ``with`` deletes them at its end; those written with ``keep``, which a
    result still reads, go when the application ends."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.own = spark, []

    def __enter__(self) -> Space:
        return self

    def write(self, df: DataFrame, name: str, keep: bool = False, group: int | None = None) -> DataFrame:
        """``group``: bytes of a row group, for large rows; else it is looked at after 100 rows only, and 128 MB."""
        path = f"{shared_folder(self.spark)}/pennant-{name}-{uuid.uuid4().hex}"
        out = df.write.option("compression", "zstd")
        if group is not None:
            out = out.option("parquet.block.size", group).option("parquet.page.size.row.check.min", 4)
        out.parquet(path)
        if keep:
            at, system = self._at(path)
            system.deleteOnExit(at)
        else:
            self.own.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _at(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def __exit__(self, *failure: object) -> None:
        for path in self.own:
            at, system = self._at(path)
            system.delete(at, True)


def _plain_scan(df: DataFrame) -> bool:
    """Whether a frame is a scan of files with nothing but columns and fixed filters on top."""
    node = df._jdf.queryExecution().analyzed()
    while node.deterministic() and node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.children().size() == 0 and node.nodeName().startswith(("LogicalRelation", "Relation"))


def numbered(df: DataFrame, space: Space, name: str = "row") -> DataFrame:
    """(row, whole): 16 bytes that name each row, by its file and its place in the file.

    They are the same at every evaluation, however the files are split between tasks then. A frame that is no plain scan
    of Parquet files is written first, and its rows are named by that copy.
    """
    if "_metadata" in df.columns or not _plain_scan(df) or not _has_rows(df):
        df = space.write(df.select(F.struct("*").alias("whole")), "rows", keep=True)
        whole = F.col("whole")
    else:
        whole = F.struct("*").alias("whole")
    at = [F.lpad(F.hex(c), 16, "0") for c in (F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index"))]
    return df.select(F.unhex(F.concat(*at)).alias(name), whole)


def _has_rows(df: DataFrame) -> bool:
    try:
        return bool(df.select("_metadata.row_index").columns)
    except AnalysisException:  # files of a kind without row numbers
        return False


def key_of(column: Column) -> Column:
    """Text as a key that is never null and sorts like it, null first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


RUN = 1 << 16


def repeated(df: DataFrame, times: str, place: str) -> DataFrame:
    """Each row ``times`` times, numbered from 0 in ``place``; a row with very many copies is dealt out in runs."""
    one = df.where(F.col(times) <= RUN).withColumn(place, F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1)))
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / RUN)))
    last = F.least(F.col(times), (F.col("_run") + 1) * RUN) - 1
    many = df.where(F.col(times) > RUN).withColumn("_run", run)
    many = many.repartition(*[c for c in many.columns]).withColumn(place, F.explode(F.sequence(F.col("_run") * RUN, last)))
    return one.unionByName(many.drop("_run"))


def fold(text: Column) -> Column:
    """A-Z, and no other letter, in lower case."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % mod


def components(space: Space, edges: DataFrame) -> DataFrame:
    """(node, component) with the smallest node reachable over edges (a, b); nodes without an edge are left out.

    Each round takes the smallest label among a node and its neighbours and then the label of that label, so
    that the rounds grow with the logarithm of a chain; it goes on until no label moves. Labels are one row per node; a node with very many edges
    is combined map-side, and its edges are split by the join at run time.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = space.write(both.where("a <> b"), "edges")
    labels = space.write(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("seen"))
        step = labels.join(near, "a").select("a", "label", F.least("label", "seen").alias("low"))
        onward = labels.select(F.col("a").alias("low"), F.col("label").alias("next"))
        labels = space.write(
            step.join(onward, "low").select("a", F.least("low", "next").alias("label"), (F.least("low", "next") < F.col("label")).alias("moved")),
            "labels",
        )
        if labels.where("moved").limit(1).count() == 0:
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
        labels = labels.drop("moved")

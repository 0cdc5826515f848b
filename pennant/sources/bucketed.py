"""Tables bucketed and sorted by a key: grouping, windows and joins on the key need no exchange, and a look-up of one key
reads one bucket, in it the row groups whose bounds and Bloom filter admit the key."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column metadata of a bucketed table's key: the rows of a key lie together.
CLUSTERED = "clustered"


def _name(path: str) -> str:
    return "pennant_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_bucketed(df: DataFrame, path: str, key: str, *sort: str, buckets: int | None = None) -> str:
    """Replace the table at ``path``; rows are moved once, by ``key``, and every bucket is one sorted file.

    ``buckets`` is the session's number of shuffle partitions if not given. The number is stored beside the files.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    (
        df.repartition(n, key)
        .write.format("parquet").mode("overwrite").option("path", path)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .bucketBy(n, key).sortBy(key, *sort).saveAsTable(_name(path))
    )
    spec = spark.range(1).select(F.lit(n).alias("buckets"), F.lit(key).alias("key"), F.array(*[F.lit(c) for c in (key, *sort)]).alias("sorted"))
    spec.coalesce(1).write.mode("overwrite").json(f"{path}/_buckets")
    return path


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``write_bucketed`` wrote, in this session or another; its key is marked as clustered."""
    spec = spark.read.schema("buckets int, key string, sorted array<string>").json(f"{path}/_buckets").first()
    if not spark.catalog.tableExists(_name(path)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        order = ", ".join(f"`{c}`" for c in spec.sorted)
        where = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {_name(path)} ({columns}) USING parquet CLUSTERED BY (`{spec.key}`) SORTED BY ({order}) "
            f"INTO {spec.buckets} BUCKETS LOCATION '{where}'"
        )
    return spark.table(_name(path)).withMetadata(spec.key, {CLUSTERED: True})

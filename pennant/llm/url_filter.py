"""URL filter: a blocked Bloom filter of the listed canonical URLs, then an exact hash join.

A rule is (verdict, host, path). It fits a url whose host is the rule's or a subdomain of it and whose path starts
with the rule's path; the longest rule (host and path together, then host) wins, and of equal rules ``block``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.llm.common import fold

KEYS_PER_BLOCK = 4  # listed rules to a 64-bit block: 16 bits each, so that one url in some hundred is a false hit
LEAST_BLOCKS = 1 << 10
SENT_BLOCKS = 1 << 20  # a filter of so many blocks, 8 MB of bits, is still sent to every task
PROBES = 4


def blocks_for(rules: int) -> int:
    """Blocks of the filter for a list of so many rules: a power of two."""
    return max(LEAST_BLOCKS, 1 << max(0, (-(-rules // KEYS_PER_BLOCK) - 1).bit_length()))


def canonical(url: Column) -> tuple[Column, Column]:
    """(host, path): host with A-Z in lower case; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return fold(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> Column:
    """The bits of a key within its 64-bit block."""
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")
    out = None
    for j in range(PROBES):
        bit = F.call_function("shiftleft", one, F.pmod(F.shiftrightunsigned(h, 6 * j), F.lit(64)).cast("int"))
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of the blocks in use."""
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(F.bit_or(_bits(F.col("key"))).alias("bits"))


def url_verdicts(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id", default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``.

    ``rules``: (verdict, host, path); a null host or path counts as empty. A url that no rule fits, null and
    malformed ones included, gets a null rule and ``default``. Repeated rows repeat; other columns are not read.
    Verdicts are worked out once per distinct (host, path), so a url that fills a third of the table costs one row.
    The filter is sized by the counted rules and sent to every task up to SENT_BLOCKS; a larger one is joined by its blocks.
    """
    blocks = blocks_for(rules.count())
    host, path = canonical(F.col(url_col))
    seen = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    listed = (
        rules.select("verdict", F.coalesce("host", F.lit("")).alias("h"), F.coalesce("path", F.lit("")).alias("p"))
        .groupBy(F.concat_ws("\x00", "h", "p").alias("key"), "h", "p")
        .agg(F.max("verdict").alias("verdict"))  # "block" after "allow"
    )
    lengths = listed.agg(F.collect_set(F.length("p"))).scalar()
    labels = F.split("host", r"\.", -1)
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.transform(
        F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.col("path").substr(F.lit(1), n)
    )
    tried = (
        seen.where("host <> ''")
        .select("host", "path").distinct()
        .withColumn("lengths", lengths)
        .select("host", "path", F.explode(tails).alias("h"), heads.alias("heads"))
        .select("host", "path", "h", F.explode("heads").alias("p"))
        .select("host", "path", "h", F.concat_ws("\x00", "h", "p").alias("key"))
        .select("*", _block(F.col("key"), blocks).alias("block"), _bits(F.col("key")).alias("mask"))
    )
    filter_ = bloom(listed, blocks)
    possible = tried.drop("h").join(F.broadcast(filter_) if blocks <= SENT_BLOCKS else filter_, "block").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    hit = possible.select("host", "path", "key").join(listed, "key")
    best = hit.groupBy("host", "path").agg(
        F.max(F.struct(F.length("key").alias("n"), F.length("h").alias("nh"), F.concat("h", "p").alias("rule"), "verdict")).alias("best")
    )
    return seen.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")

"""Corpus pipeline: from raw documents to token ids, stage by stage.

Every stage takes null ids, sources and languages, repeated rows, very long texts and empty tables, and returns the
columns it got, but for the last. Documents without a letter (null and empty texts too) end at the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.llm.common import Space, ship_code
from pennant.llm.decontaminate import decontaminate
from pennant.llm.exact_dedup import exact_dedup
from pennant.llm.jaccard_join import one_of_each
from pennant.llm.language_id import keep_known
from pennant.llm.queries import SENTENCEPIECE_MODEL
from pennant.llm.sentencepiece_codec import encode, load


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; text without letters has none."""
    ship_code(spark)
    return keep_known(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of texts that are equal without white space: most code points, then smallest id, null last."""
    ship_code(spark)
    return exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked texts: the one of smallest id, null last. Wordless texts stay."""
    ship_code(spark)
    return one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; an empty benchmark drops nothing."""
    ship_code(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and whether decoding them gives the text back; no text, no ids."""
    ship_code(spark)
    coded = encode(docs, load(SENTENCEPIECE_MODEL), carried=["doc_id", "lang", "source"])
    return coded.select("whole.*", F.size("ids").alias("n_tokens"), "ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("decontaminate", without_benchmark),
    ("sentencepiece", token_ids),
]

# A trained network decides in the first stage, so SQL cannot express the rows; tests/llm holds the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Space(spark) as space:
        for name, stage in STAGES:
            docs = space.write(stage(spark, docs, sf_dir), name, keep=name == STAGES[-1][0])
    return docs

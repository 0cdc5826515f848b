"""Every query and every pipeline stage on a table of odd rows, and on an empty one."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pennant.llm.queries import QUERIES

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use for columns of their own
CLASHES = ["row", "whole", "key", "id", "node", "part", "cls", "hash", "held", "forest", "pos", "leaf", "size", "bucket", "block", "label"]
PAGES = "page_id long, url string, html string"


def odd_documents():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(600_000))  # some MB in one row
    one = " ".join(rng.choice(words) for _ in range(300))
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "a", 0), (2, "   \n\t", "en", "", 5), (3, long, "en", "hot", len(long)),
        (4, one, None, "hot", 1), (4, one, None, "hot", 1), (5, one + " end", "fr", None, None), (None, one, "en", "a", 3), (6, "word", "de", "a", 4),
        (7, "\x00 \x1d odd   signs \U0001f600 ▁", "en", "hot", 9), (8, "12 34 !!", "en", "hot", 8), (-9, "<s> </s> <|endoftext|>", "en", "hot", 5),
    ]
    return rows + [(100 + i, " ".join(rng.choice(words) for _ in range(40)), rng.choice(["en", "fr"]), "hot", 200) for i in range(30)]


def write(spark, folder, documents, pages):
    docs = spark.createDataFrame(documents, DOCUMENTS)
    docs.withColumns({c: F.lit("x") for c in CLASHES}).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(pages, PAGES).withColumns({c: F.lit(1) for c in ("text", "host", "row")}).write.parquet(f"{folder}/pages.parquet")
    items = [(1, "What is the price of 3 apples in Boston today if one costs 50 cents ?"), (2, None), (3, ""), (None, "x y z")] if documents else []
    spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1)).write.parquet(f"{folder}/benchmark.parquet")
    labels = [(4, 1, 0), (6, 0, 1), (None, 1, 0), (100, 1, 0), (101, 0, 0)] if documents else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    pages = [(None, None, None), (1, "", ""), (2, "http://", "<p>"), (2, "no scheme", "<article><p>Some words here, at last.</article>"), (3, "HTTP://A.COM/en/", "x" * 3_000_000)]
    return write(spark, tmp_path_factory.mktemp("odd"), odd_documents(), pages)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [], [])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_odd_rows(spark, odd, name):
    rows = QUERIES[name](spark, odd).collect()
    if name == "op2_decontaminate":
        assert rows == []
    else:
        assert len(rows) == (5 if name in ("op8_url_filter", "op10_html_extract") else len(odd_documents()))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_pipeline_on_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, odd)
        rows = docs.collect()
        ids[name] = sorted((r.doc_id is None, r.doc_id or 0) for r in rows)
        if name != "sentencepiece":
            assert docs.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)  # no scan of files
    assert (False, 3) in ids["sentencepiece"] and (False, 1) not in ids["language_id"]
    assert ids["exact_dedup"].count((False, 4)) == 1 and (True, 0) not in ids["exact_dedup"]  # of equal texts the smallest id
    assert (False, 5) not in ids["jaccard_join"] and ids["jaccard_join"] == ids["decontaminate"] == ids["sentencepiece"]


def test_pipeline_on_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []

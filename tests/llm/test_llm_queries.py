"""Registered queries: against their SQL, and the pipeline against its stages' brute-force versions."""

import pytest
from checks.compare import _sorted_rows, database

from pennant.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = database(SF).execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == _sorted_rows(columns, result.fetchall())


def test_pipeline_stages(spark):
    import re

    import corpus_pipeline as pipeline
    from pennant.llm.common import Space

    assert [n for n, _ in pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontaminate", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs.collect()]
    with Space(spark) as space:
        for name, stage in pipeline.STAGES:
            docs = space.write(stage(spark, docs, SF), name)
            kept.append(docs.collect())
            if name != "sentencepiece":
                assert docs.columns == columns
    sizes = [len(k) for k in kept]
    assert sizes == sorted(sizes, reverse=True)
    known, distinct, apart, clean, coded = kept[1:]
    assert len(known) == sizes[0]  # every text of this table has a language
    body = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert len({body(r.text) for r in known}) == len(distinct) == len({body(r.text) for r in distinct})
    sets = {r.doc_id: {tuple(w[i : i + 5]) for w in [r.text.lower().split()] for i in range(max(1, len(w) - 4))} for r in distinct}
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ids = [r.doc_id for r in apart]
    assert not any(alike(a, b) for i, a in enumerate(ids) for b in ids[:i])
    assert all(any(alike(r.doc_id, o) for o in sets if o != r.doc_id) for r in distinct if r.doc_id not in set(ids))
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in clean} == {r.doc_id for r in apart if not any(i in r.text for i in items)}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in coded) and len(coded) == len(clean)

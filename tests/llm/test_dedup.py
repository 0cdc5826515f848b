"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pennant.llm.common import Space, components, ship_code
from pennant.llm.exact_dedup import Trie, exact_dedup, exact_groups
from pennant.llm.jaccard_join import jaccard_components, one_of_each
from pennant.llm.substring_dedup import repeated, substring_dedup, suffix_array

SCHEMA = "doc_id long, text string, row string, whole long, node string, token string, sha string"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    ship_code(spark)
    return spark.createDataFrame([(i, t, "r", 1, "n", "t", "s") for i, t in rows], SCHEMA)


def near_copies(seed=1, families=25):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    rows = []
    for f in range(families):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 30, 80, 200]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(30)]
    rows += [rows[0], rows[0].upper() + "  ", "", " \t\n", "one", "One", "a b", "a b c d"]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)] + [(10_000, None), (None, rows[0]), (None, "lonely text of a null id"), (7, rows[7])]


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [w.lower() for w in words]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)].append(doc)
    return Counter((doc, len(s), doc if not s else min(ids[find(i)], default=None)) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, seed):
    rows = near_copies(seed)
    got = jaccard_components(frame(spark, rows)).collect()
    assert Counter(tuple(r)[:3] for r in got) == brute_components(rows)


def test_one_of_each_keeps_columns_and_wordless(spark):
    rows = near_copies(3, 8)
    docs = frame(spark, rows)
    kept = one_of_each(docs).collect()
    assert kept[0].__fields__ == docs.columns
    want = brute_components(rows)
    linked = len({c for (_, n, c) in want if n and c is not None}) + sum(1 for (_, n, c) in want if n and c is None)
    assert len(kept) == linked + sum(k for (_, n, _), k in want.items() if not n)


def test_components_of_a_chain(spark):
    ship_code(spark)
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    with Space(spark) as space:
        got = {r.node: r.component for r in components(space, edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_empty_tables(spark):
    none = frame(spark, [])
    for op in (jaccard_components, exact_groups, substring_dedup, exact_dedup, one_of_each):
        assert op(none).count() == 0


def test_exact_groups(spark):
    rng = random.Random(4)
    texts = ["", None, " \n", "ab", "a b", "a  b", "a\tb", "ab ", "abc", "ab ", "é a", "éa", "x" * 5000, "x" * 4999 + " x"]
    rows = [(i, rng.choice(texts)) for i in range(120)] + [(None, "ab"), (None, "only null"), (500, "dup"), (500, "dup"), (501, "dup")]
    bodies = defaultdict(list)
    for i, t in rows:
        bodies[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0))
    got = exact_groups(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(b.encode()).hexdigest(): sorted(x) for b, x in bodies.items()}
    for r in got:
        group = by_sha[r.text_sha256]
        assert r.group_size == len(group)
        assert r.keep_id == (None if group[0][1] else group[0][2])
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(by_sha.keys())
    assert exact_dedup(frame(spark, rows)).count() == len(by_sha)


def test_trie_spills_whole_subtrees():
    rng = random.Random(5)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    trie, out = Trie(), Counter()
    for i, k in enumerate(keys):
        trie.insert(k, (0, False, i, i, 1))
        if trie.cost > 4000:
            out.update({k: o[4] for k, o in trie.spill()})
    for k, o in trie.terminals():
        out[k] += o[4]
    assert out == Counter(keys)


def test_suffix_array_orders_first_bytes():
    rng = np.random.default_rng(6)
    for text in (rng.integers(97, 100, 3000), np.full(900, 97), rng.integers(0, 256, 2000), np.tile([98, 97, 97], 400)):
        data = bytes(text.astype(np.uint8))
        got = suffix_array(np.frombuffer(data, np.uint8)).tolist()
        assert sorted(got) == list(range(len(data)))
        heads = [data[i : i + 400] for i in got]
        assert all(a.rstrip(b"\0") <= b.rstrip(b"\0") for a, b in zip(heads, heads[1:]))


def test_repeated_strings_of_segments():
    rng = random.Random(7)
    piece = bytes(rng.randrange(256) for _ in range(450))
    contents = [bytes(rng.randrange(256) for _ in range(30)) + piece + bytes(rng.randrange(256) for _ in range(k)) for k in (0, 10, 25)]
    count = Counter(c[i : i + 400] for c in contents for i in range(len(c) - 399))
    for c, flags in zip(contents, repeated(contents)):
        assert flags.tolist() == [count[c[i : i + 400]] > 1 for i in range(len(c) - 399)]


def brute_removed(rows):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    out = Counter()
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - 399):
            if count[t[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), any(gone), sum(gone) / len(t) if t else 0.0] += 1
    return out


@pytest.mark.parametrize("group", [400, 2])
def test_substring_dedup(spark, group, monkeypatch):
    from pennant.llm import substring_dedup as module

    monkeypatch.setattr(module, "GROUP", group)  # 2: nearly all anchors are settled by hash, in many blocks and buckets
    monkeypatch.setattr(module, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(module, "BUCKET_STRINGS", 100)
    rng = random.Random(8)

    def noise(n):
        return "".join(rng.choice("abcdé \n") for _ in range(n))

    passage, other = noise(700), noise(405)
    texts = [noise(rng.randint(0, 300)) + passage + noise(rng.randint(0, 300)) for _ in range(12)]
    texts += [noise(50) + other + noise(3), other, noise(900), noise(399), "", None, "a" * 1500, "ab" * 700, passage[:420], passage[5:]]
    texts += [texts[0], passage[:350] + noise(20) + passage[350:], noise(3000) + passage + noise(10) + passage]
    rows = list(enumerate(texts)) + [(None, texts[1]), (3, texts[3]), (900, "é" * 300)]
    got = substring_dedup(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == brute_removed(rows)


@pytest.fixture
def few_splits(spark):
    """A way to change how many splits a scan has."""
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k, None) for k in names}

    def splits(n, size):
        for k, v in zip(names, (n, size, 1000)):
            spark.conf.set(k, str(v))

    yield splits
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


OPERATORS = ["op1_jaccard_join", "op2_decontaminate", "op3_exact_dedup", "op5_substring_dedup", "op9_lm_score", "op11_entropy_mix", "op12_token_alignment", "op13_merkle_manifest"]
STAGES = ["exact_dedup", "jaccard_join", "decontaminate"]


@pytest.mark.parametrize("name", OPERATORS + STAGES)
def test_rows_keep_their_names_when_splits_change(spark, few_splits, tmp_path, name):
    import corpus_pipeline
    from pennant.llm.queries import QUERIES

    sf = str(tmp_path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    docs.coalesce(1).write.option("parquet.block.size", 60_000).parquet(f"{sf}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")

    def frame():
        if name in OPERATORS:
            return QUERIES[name](spark, sf)
        return dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)

    few_splits(1, 100 << 20)
    assert spark.read.parquet(f"{sf}/documents.parquet").rdd.getNumPartitions() == 1
    expect = Counter(tuple(r) for r in frame().collect())
    built = frame()
    few_splits(16, 30_000)
    assert spark.read.parquet(f"{sf}/documents.parquet").rdd.getNumPartitions() > 4
    assert Counter(tuple(r) for r in built.collect()) == expect


def test_frames_that_are_no_scan_are_written_before_rows_are_named(spark):
    from pennant.llm.common import numbered

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    twice = docs.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    with Space(spark) as space:
        assert space.own == [] and numbered(docs.where("doc_id > 3"), space).select("row").distinct().count() == docs.count() - 4
        assert numbered(twice, space).select("row").distinct().count() == 2 * docs.count()
        assert numbered(docs.union(docs), space).select("row").distinct().count() == 2 * docs.count()
        assert numbered(docs.withColumn("_metadata", F.lit(1)), space).select("row").distinct().count() == docs.count()

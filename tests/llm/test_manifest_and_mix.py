"""The Merkle manifest and the entropy-balanced mix against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pennant.llm.entropy_mix import mix
from pennant.llm.merkle_manifest import FAN, manifest, tampered_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos long, leaf string, forest string, load int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def proofs(digests):
    """[(left, right), ...] from the bottom per node, and what remains."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, path in enumerate(paths):
            run = at[i] // FAN * FAN
            path.append(("".join(level[run : at[i]]), "".join(level[at[i] + 1 : run + FAN])))
            at[i] //= FAN
        level = [sha(*level[k : k + FAN]) for k in range(0, len(level), FAN)]
    return paths, level[0]


def brute_manifest(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    forests = defaultdict(list)
    for r in rows:
        forests[r[1]].append(r)
    order = sorted(forests, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: proofs([leaf(r) for r in sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s, v in forests.items()}
    above, root = proofs([trees[s][1] for s in order])
    out = []
    for s, up in zip(order, above):
        ranked = sorted(forests[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for r, path in zip(ranked, trees[s][0]):
            path = path + up
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            seen = leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4]))) if bad else leaf(r)
            got = seen
            for a, b in path:
                got = sha(a, got, b)
            out.append((r[0], leaf(r), trees[s][1], root, sha(*[a + b for a, b in path]), got, got == root))
    return Counter(out)


def documents(seed, n, ids):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        text = rng.choice([None, "", "Ab cd", "é日本 X", "x" * rng.randint(1, 50)])
        rows.append((ids(rng), rng.choice([None, "", "a", "b", "é", "hot", "hot", "hot"]), rng.choice([None, "en"]), rng.choice([None, 3]), text))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "l", "f", 2) for r in rows], SCHEMA)


CASES = {
    "dense": documents(1, 700, lambda r, it=iter(range(10_000)): next(it)),
    "sparse and negative": documents(2, 300, lambda r: r.choice([-1, 1]) * r.getrandbits(63)),
    "repeats and nulls": documents(3, 400, lambda r: r.choice([None, 5, 5, 64, 65, -64, r.randint(0, 90), (1 << 63) - 1, -(1 << 63)])),
    "one": [(7, "s", "en", 1, "T")],
    "equal rows": [(1, "s", None, 2, "A")] * 40 + [(0, "s", None, 2, "A"), (2, None, None, None, None)],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_manifest_matches_brute_force(spark, case):
    got = tampered_manifest(table(spark, CASES[case]))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in got.collect()) == brute_manifest(CASES[case])


def test_empty_table_has_no_root(spark):
    assert tampered_manifest(table(spark, [])).count() == 0


def test_untouched_rows_verify_and_foreign_ones_do_not(spark):
    docs = table(spark, CASES["dense"])
    assert manifest(docs).where("NOT verified").count() == 0
    assert manifest(docs, F.when(F.col("doc_id") < 9, F.sha2(F.lit("x"), 256))).where("NOT verified").count() == 9


def brute_targets(sizes):
    """Shares of 150 %, filled up source by source as the rule says it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - 2 * sizes[s]) for s in open_)
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def mixed(spark, rows):
    """Rows are (doc_id, source, words)."""
    docs = [(i, s, "en", 1, None if n is None else "\x1d ".join(["w"] * n), 1, "l", "f", 2) for i, s, n in rows]
    return mix(spark.createDataFrame(docs, SCHEMA)).collect()


def check_mix(rows, got, slack):
    """``slack``: how far a source may be from its target, in words."""
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, n or 0) for i, _, n in rows)
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n or 0
    expect = brute_targets(sizes)
    assert Counter((r.source_size, round(r.target, 4)) for r in got) == Counter((sizes[s], round(expect[s], 4)) for _, s, _ in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2 and 0 <= r.rate <= 2
        taken[r.source_size, round(r.target, 4)] += r.taken
    for (size, target), words in taken.items():
        assert abs(words - target) <= slack * sum(1 for s in sizes if sizes[s] == size), (size, target, words)


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", "é", "", None]), int(rng.paretovariate(1.1)) % 5000 + rng.choice([0, 0, 40])) for i in range(3000)]
    got = mixed(spark, rows)
    check_mix(rows, got, 40)
    again = mixed(spark, rows[::-1])
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_rates_are_tilted_by_size_and_balanced(spark):
    rng = random.Random(6)
    rows = [(i, "abc"[i % 3], rng.randint(1, 300)) for i in range(600)]
    got = mixed(spark, rows)
    for target in {r.target for r in got}:
        own = [r for r in got if r.target == target]
        assert abs(sum(r.rate * r.size for r in own) - target) < 1e-3 + 1e-6 * target
        tilted = [math.log(r.rate) / r.size for r in own if r.rate < 2]
        assert not tilted or max(tilted) - min(tilted) < 1e-9


def test_mix_with_nulls_repeats_and_empty_texts(spark):
    rows = [(None, None, 7), (None, None, 7), (1, "a", None), (1, "a", 0), (2, "a", 3), (2, "a", 3), (3, "b", 0), (4, "c", 1)] + [(9, "c", 5)] * 70
    check_mix(rows, mixed(spark, rows), 7)


def test_mix_of_few_long_documents_errs_by_less_than_one(spark):
    rows = [(1, "a", 5000), (2, "a", 300), (3, "a", 20), (4, "b", 9000), (5, "c", 100)]
    check_mix(rows, mixed(spark, rows), 5000)


def test_mix_of_an_empty_table(spark):
    assert mixed(spark, []) == []


def test_repeated_rows_in_runs(spark, monkeypatch):
    import pennant.llm.common as common

    monkeypatch.setattr(common, "RUN", 4)
    df = spark.createDataFrame([(1, 1), (2, 4), (3, 5), (4, 13)], "id long, m long")
    got = Counter((r.id, r.copy) for r in common.repeated(df, "m", "copy").collect())
    assert got == Counter((i, k) for i, m in [(1, 1), (2, 4), (3, 5), (4, 13)] for k in range(m))

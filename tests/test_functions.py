import random

from pyspark.sql import functions as F

from pennant.functions import list_position, ordered_sum, padded, ratio, remap, rounded_mean, rounded_units, sums_before, year_span
from pennant.operators.enrich import Decimal, share_filter
from pennant.operators.ranking import numbered
from pennant.functions import asc_last, desc_last
from pennant.plans.reports import ranked


def test_ordered_sum_is_the_left_fold_per_block(spark):
    rng = random.Random(7)
    rows = [("a" if i % 3 else "b", i, rng.uniform(-1, 1) * 10 ** rng.randint(-8, 8)) for i in range(1000)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "k string, o long, x double").repartition(7)

    def fold(values):
        acc = None
        for v in values:
            acc = v if acc is None else acc + v
        return acc

    expect = {key: fold([x for k, o, x in sorted(rows, key=lambda r: r[1]) if k == key]) for key in ("a", "b")}
    got = {r.k: r.total for r in ordered_sum(df, ["k"], "x", "o").collect()}
    assert got == expect


def test_ordered_sum_has_no_edges(spark):
    """The plain left fold wherever the line numbers lie, and over several partitions."""
    values = [0.1, 0.2, -0.3, 1e16, 1.0, -1e16]
    for first in (1, 65_533, 131_070, (1 << 36) - 2):
        df = spark.createDataFrame([("k", first + i, x) for i, x in enumerate(values)] + [("n", 5, None)], "k string, o long, x double").repartition(3)
        total = 0.0
        for i, x in enumerate(values):
            total = x if i == 0 else total + x
        assert [(r.k, r.total) for r in ordered_sum(df, ["k"], "x", "o").collect()] == [("k", total)]


def test_numbered_matches_a_plain_sort(spark):
    rng = random.Random(3)
    # a third of all rows share one value
    rows = [(i, 5 if i % 3 == 0 else rng.randint(0, 50), "x" if i % 5 else "y") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v int, k string").repartition(6)
    orders = [desc_last("v"), asc_last("id")]
    got = {r.id: r.rank for r in numbered(df, orders).collect()}
    assert got == {r[0]: n + 1 for n, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    per_key = {(r.k, r["rank"]): r.id for r in numbered(df, orders, keys=["k"]).collect()}
    for key in ("x", "y"):
        ids = [r[0] for r in sorted((r for r in rows if r[2] == key), key=lambda r: (-r[1], r[0]))]
        assert [per_key[(key, n + 1)] for n in range(len(ids))] == ids


def test_ranked_keeps_sort_order(spark):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("v")).repartition(5).orderBy("v")
    assert all(r["rank"] == r.v + 1 for r in ranked(df).collect())
    assert [(r["rank"], r.v) for r in ranked(df.limit(3)).orderBy("rank").collect()] == [(1, 0), (2, 1), (3, 2)]


def test_small_columns(spark):
    df = spark.createDataFrame([("mon", 10, 4, "SS"), ("bos", 0, 0, "??"), (None, -150, 100, None)], "t string, a int, b int, p string")
    rows = df.select(
        remap("t", {"mon": "wsn"}).alias("t"), ratio("a", "b").alias("r"), rounded_mean("a", "b").alias("m"),
        rounded_units("a", 100).alias("u"), year_span("a", "b").alias("y"), list_position("p", ["C", "SS"]).alias("p"),
        padded("t", 5).alias("l"), padded("t", 2, "right").alias("w"),
    ).collect()
    assert [r.t for r in rows] == ["wsn", "bos", None]
    assert [r.r for r in rows] == [2.5, None, -1.5]
    assert [r.m for r in rows] == [3, None, -2]
    assert [r.u for r in rows] == [0, 0, -2]
    assert rows[0].y == "(10-4)"
    assert [r.p for r in rows] == [2, 3, 3]
    assert [r.l for r in rows] == ["mon  ", "bos  ", "     "]
    assert [r.w for r in rows] == ["mon", "bos", "  "]


def test_share_is_exact_at_the_limit(spark):
    rows = [("a", "x", 97), ("a", "y", 3), ("b", "x", 98), ("b", "y", 2)]
    df = spark.createDataFrame(rows, "k string, c string, n long")
    kept = {(r.k, r.c) for r in share_filter(df, ["k"], "n", Decimal("0.03")).collect()}
    assert kept == {("a", "x"), ("a", "y"), ("b", "x")}


def test_running_sums_by_directories(spark):
    rng = random.Random(7)
    rows = list({(g, rng.choice([-1, 1]) * rng.getrandbits(rng.choice([4, 20, 62]))): rng.randint(1, 9) for g in "ab" for _ in range(300)}.items())
    df = spark.createDataFrame([(g, k, v) for (g, k), v in rows], "g string, k long, v long")
    got = {(r.g, r.k): (r.start, r.total) for r in sums_before(df, ["g"], "k", "v", (10, 16, 16)).collect()}
    for (g, k), _ in rows:
        assert got[g, k] == (sum(v for (o, x), v in rows if o == g and x < k), sum(v for (o, _), v in rows if o == g))

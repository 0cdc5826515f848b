"""Shape of the physical plans, and results under a hot key."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from pennant.operators import awards, enrich, groups, leaders, rollups, streaks
from pennant.sources.checkpoints import cut_lineage

SF = "/root/testdata/sf0.001"
# Windows over a bounded frame (top n rows, one row per group, one row per partition) and global aggregates.
ONE_PARTITION_OK = (
    "t06_best_rosters_ranked", "t07_best_roster_per_group_ranked", "t12_", "t15_", "t16_value_per_cost_active", "t32_", "e3_numbered",
    "a10_text_report",
)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairs_or_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert bad not in plan
    if not name.startswith(ONE_PARTITION_OK):
        assert "SinglePartition" not in plan


def test_first_aggregation_is_by_hash(spark):
    for name in ("t01_career_leaders", "t06_best_rosters", "t09_longest_streak", "t21_retention"):
        assert "SortAggregate" not in QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_trimmed_before_the_shuffle(spark):
    plan = QUERIES["t21_retention"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("WindowGroupLimit") == 2


def test_scan_reads_only_what_is_needed(spark):
    plan = QUERIES["t06_best_rosters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unused in ("l_returnflag", "l_tax", "p_type", "c_name", "o_totalprice"):
        assert unused not in plan


@pytest.fixture(scope="module")
def hot(make_lines):
    """A third of all lines belong to one entity."""
    rng = random.Random(1)
    rows = []
    for i in range(6000):
        who = "hot" if i % 3 == 0 else f"e{rng.randint(0, 400)}"
        rows.append((who, who.upper(), rng.randint(2000, 2012), rng.choice("ABCDEFG"), rng.randint(0, 1), rng.randint(-50, 60) / 4))
    return rows, make_lines(rows).repartition(8).cache()


def test_hot_entity_stays_small_after_the_first_step(hot):
    rows, lines = hot
    per_stint = rollups.stints(lines).where("entity = 'hot'")
    assert per_stint.count() == 13 * 7
    assert per_stint.agg(F.sum("n_lines")).first()[0] == 2000


def test_hot_entity_results(hot):
    rows, lines = hot
    careers, seasons, order = defaultdict(float), defaultdict(float), {}
    numbers = defaultdict(int)
    for who, _, year, _, source, m in rows:
        numbers[source] += 1
        at = (source, numbers[source])
        careers[who] += m
        seasons[(who, year)] += m
        order[(who, year)] = min(order.get((who, year), at), at)
    expect = sorted(careers.items(), key=lambda kv: (-kv[1], kv[0].upper(), kv[0]))[:20]
    assert [(r.entity, float(r.total)) for r in leaders.career_leaders(lines, 20).collect()] == expect
    lengths = {}
    for who in careers:
        own = sorted((y for w, y in seasons if w == who), key=lambda y: order[(who, y)])
        best = run = 0
        for y in own:
            run = run + 1 if seasons[(who, y)] > 10 else 0
            best = max(best, run)
        lengths[who] = best
    got = {r.entity: r.periods for r in streaks.longest_streak(lines, 10, 1000).collect()}
    assert got == lengths
    rosters = defaultdict(set)
    for who, _, year, grp, _, _ in rows:
        rosters[(year, grp)].add(who)
    got = {(r.period, r.grp): float(r.total) for r in groups.rosters(lines).collect()}
    assert got == {k: sum(careers[w] for w in v) for k, v in rosters.items()}


def test_hot_season_enrichment(spark):
    rows = [("hot" if i % 3 == 0 else f"p{i % 50}", 2000, i % 4 + 1, "AL", 10, i) for i in range(3000)]
    lines = spark.createDataFrame(rows, "player_ID string, year_ID int, stint_ID int, lg_ID string, G int, line_no long")
    lists = spark.createDataFrame([("HOT", 2000, "MVP"), ("p1", 2000, "ROY")], "entity string, period int, awards string")
    out = enrich.attach_awards(lines, lists)
    assert out.count() == 3000
    assert out.where("awards = 'MVP'").count() == sum(1 for r in rows if r[0] == "hot" and r[2] == 1)


def test_salted_rivals_find_every_pair(spark, make_lines):
    lines = make_lines([(f"p{i}", f"P{i}", 2000, "X", 1, i) for i in range(200)])
    won = spark.createDataFrame([("p150", 2000, "CY", "ML", True)], "entity string, period int, award string, league string, winner boolean")
    got = awards.award_snubs(lines, won, "CY", 1000, since=1956, leagues=["AL"]).collect()
    assert [r.entity for r in got] == [f"p{i}" for i in range(199, 150, -1)]


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.startswith("t32_") or n in ("t12_cost_per_value_active", "t16_value_per_cost_active", "t21_average_retention")])
def test_lines_are_scanned_once(spark, monkeypatch, name):
    from pennant.operators import active, value

    plans = []

    def counted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df)

    for module in (active, value):
        monkeypatch.setattr(module, "cut_lineage", counted)
    plans.append(QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
    assert sum(len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", p)) for p in plans) == 1


def test_hot_season_is_split_at_run_time(spark):
    """The one join of the enrichment: a season with a third of all lines goes to more tasks than one."""
    rows = [("hot" if i % 3 == 0 else f"p{i % 500}", 2000, i % 4 + 1, "AL", 10, i, "x" * 200) for i in range(30_000)]
    lines = spark.createDataFrame(rows, "player_ID string, year_ID int, stint_ID int, lg_ID string, G int, line_no long, note string")
    lists = spark.createDataFrame([("HOT", 2000, "MVP"), *[(f"p{i}", 2000, "ROY") for i in range(500)]], "entity string, period int, awards string")
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        out = enrich.attach_awards(lines.repartition(8), lists)
        assert out.where("awards = 'MVP'").count() == sum(1 for r in rows if r[0] == "hot" and r[2] == 1)
        found = out.select("line_no", "awards", "note")
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan


def test_an_entity_s_memberships_are_sorted_once(spark):
    """A task of that step holds its rows in one sort by entity and in that of the trimming, and each row once."""
    plan = QUERIES["t21_average_retention"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Sort \[entity", plan)) == 1 and "Generate" not in plan


def test_order_lines_of_an_enrichment_are_joined_once(spark, monkeypatch):
    from checks import tables

    made, star = [], tables.star
    monkeypatch.setattr(tables, "star", lambda *a: made.append(a) or star(*a))
    for name in ("j2_awards_list", "j8_enrich_a", "j9_enrich_b"):
        made.clear()
        QUERIES[name](spark, SF)
        assert len(made) == 1


def test_sides_of_an_enrichment_are_sorted_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(enrich, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut_lineage(df))
    lines = spark.createDataFrame([("a", 2000, 1, "AL", 10, 1)], "player_ID string, year_ID int, stint_ID int, lg_ID string, G int, line_no long")
    lists = spark.createDataFrame([("A", 2000, "MVP"), ("a", 2000, "ROY"), ("b", 2000, "MVP")], "entity string, period int, awards string")
    assert [r.awards for r in enrich.attach_awards(lines, lists).collect()] == ["ROY"]
    assert len(re.findall(r"Sort \[_side_key", plans[0])) == 1

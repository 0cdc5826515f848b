import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pennant.sources import (
    Roles,
    as_lines,
    lines_from_csv,
    number_lines,
    read_bucketed,
    read_crosswalk,
    read_csv,
    read_facts,
    read_game_log,
    union_lines,
    unpivot_slots,
    write_bucketed,
    write_table,
)
from pennant.sources.files import with_file_number


def test_line_numbers_follow_file_name_and_row(spark, tmp_path):
    folder = tmp_path / "facts"
    folder.mkdir()
    # written in an order that differs from the name order; a name with a space must still be found
    for name, start, n in (("c.parquet", 200, 50), ("a.parquet", 0, 70), ("b x.parquet", 100, 90)):
        pq.write_table(pa.table({"v": list(range(start, start + n))}), folder / name, row_group_size=13)
    df = read_facts(spark, str(folder))
    rows = [r.v for r in df.orderBy("line_no").collect()]
    assert rows == sorted(rows) and len(rows) == 210
    assert df.select("line_no").distinct().count() == 210
    kept = [r.v for r in df.where("v % 7 = 3").orderBy("line_no").collect()]
    assert kept == [v for v in rows if v % 7 == 3]
    full = {r.v: r.line_no for r in df.collect()}
    assert {r.v: r.line_no for r in df.where("v > 150").collect()} == {v: n for v, n in full.items() if v > 150}


def test_single_file_numbers_from_one(spark, tmp_path):
    pq.write_table(pa.table({"v": [5, 6, 7]}), tmp_path / "one.parquet")
    df = number_lines(spark.read.parquet(str(tmp_path / "one.parquet")), "n")
    assert [(r.v, r.n) for r in df.orderBy("n").collect()] == [(5, 1), (6, 2), (7, 3)]


def test_a_file_that_is_not_listed_is_an_error(spark, tmp_path):
    for name in "abc":
        pq.write_table(pa.table({"v": [1]}), tmp_path / f"{name}.parquet")
    df = spark.read.parquet(str(tmp_path)).select("v", F.col("_metadata.file_path").alias("p"))
    with pytest.raises(Exception, match="not listed"):
        with_file_number(df, ["file:/elsewhere/a", "file:/elsewhere/b"], "p", "no").collect()


def test_text_lines_are_numbered_over_files_and_splits(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    wanted = []
    # the planner reads the largest first, and a file in several splits
    for name, n in (("a one.csv", 3), ("b.csv", 400), ("c.csv", 0), ("d.csv", 5000), ("e.csv", 90)):
        values = [f"{name}-{i}" for i in range(n)]
        wanted += values
        (folder / name).write_text("\n".join(["v,w", *[f"{v},{'x' * (i % 40)}" for i, v in enumerate(values)], ""]))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        assert spark.read.csv(str(folder)).rdd.getNumPartitions() > 5
        df = read_csv(spark, str(folder), "v string, w string", line_no="n")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")  # numbers stay what they are when splits change later
        rows = df.orderBy("n").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [r.v for r in rows] == wanted and len({r.n for r in rows}) == len(wanted)
    by_file = [r.n >> 32 for r in rows]
    assert by_file == sorted(by_file) and rows[0].n == 1 and rows[3].n == (1 << 32) + 1


def test_csv_null_text_and_schema_by_name(spark, tmp_path):
    f = tmp_path / "x.csv"
    f.write_text("b,a,extra\nNULL,1,z\nq,two,z\n")
    rows = read_csv(spark, str(f), "a int, b string, missing double", line_no="n").orderBy("n").collect()
    assert [(r.a, r.b, r.missing) for r in rows] == [(1, None, None), (None, "q", None)]
    assert rows[0].n < rows[1].n
    assert read_csv(spark, str(f), "b string", null_value=None).collect()[0].b == "NULL"


def test_lines_from_csv(spark):
    raw = spark.createDataFrame([("x", 1.5, "AL"), ("y", None, "AL"), ("z", 2.0, "FL")], "Player_ID string, WAR double, lg_ID string")
    rows = lines_from_csv(raw, "WAR", "lg_ID", ["AL", "NL"], "regular").collect()
    assert [(r.player_id, r.season_type) for r in rows] == [("x", "regular")]


def test_as_lines_filters_and_exact_measure(spark):
    raw = spark.createDataFrame(
        [("x", "X", 2000, "bos", "AL", 0.1, None, 1), ("x", "X", 2000, "bos", "AL", 0.2, 7, 2),
         ("x", "X", 2000, "bos", "FL", 9.0, 7, 3), ("x", "X", 2000, "bos", "AL", None, 7, 4)],
        "e string, n string, y int, t string, lg string, m double, pay int, line_no long",
    )
    roles = Roles("e", "n", "y", "t", "lg", "m", "pay")
    lines = as_lines(raw, roles, 1, leagues=["AL"], measure_type="decimal(12,4)")
    rows = lines.collect()
    assert [(r.grp, r.source, r.cost) for r in rows] == [("BOS", 1, 0), ("BOS", 1, 7)]
    assert str(lines.agg(F.sum("measure")).first()[0]) == "0.3000"
    everything = as_lines(raw, roles, 0, keep_null_measure=True, fold_group=None, where=F.col("t") == "bos")
    assert everything.count() == 4 and everything.first().grp == "bos"
    assert union_lines(lines, everything.withColumn("measure", F.col("measure").cast("decimal(12,4)"))).count() == 6


def _game(date, starters, fields=161):
    row = [""] * fields
    row[0] = date
    for i, (who, pos) in enumerate(starters):
        base = (105 if i < 9 else 132) + 3 * (i % 9)
        row[base], row[base + 1], row[base + 2] = who, "Last, First", pos
    return ",".join(f'"{v}"' if "," in v or v else v for v in row)


def test_game_log(spark, tmp_path):
    f = tmp_path / "gl.txt"
    starters = [(f"p{i}", str(i % 10 + 1)) for i in range(16)] + [("0", "3"), ("p99", "x")]
    good = _game("19270412", starters)
    no_year = _game("xx270412", starters)
    short = ",".join(['"19270413"'] + [""] * 120)
    f.write_text("\n".join([good, no_year, short, ""]))
    rows = {(r.id, r.period, r.code) for r in read_game_log(spark, str(f)).collect()}
    assert rows == {(f"p{i}", 1927, i % 10 + 1) for i in range(16)}


def test_unpivot_drops_blank_slots(spark):
    df = spark.createDataFrame([(1, " a ", "2"), (2, "0", "2"), (3, "", "1"), (4, "b", "1.5"), (5, None, "1")], "k int, i string, c string")
    assert [(r.k, r.id, r.code) for r in unpivot_slots(df, ["k"], [("i", "c")]).collect()] == [(1, "a", 2)]


def test_crosswalk_shards(spark, tmp_path):
    (tmp_path / "people-0.csv").write_text("x,key_a,key_b\n1, r1 ,b1\n2,,b2\n3,r3,\n")
    (tmp_path / "people-1.csv").write_text("x,key_a,key_b\n1,r4,b4\n")
    rows = read_crosswalk(spark, str(tmp_path / "people-*.csv"), "key_a", "key_b").collect()
    assert {tuple(r) for r in rows} == {("r1", "b1"), ("r4", "b4")}


def test_write_table_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def scanned_rows(df):
    """Rows that the scans of a frame's plan gave, once it has run."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.startswith("Scan"):
            return node.metrics().apply("numOutputRows").value()
        kids = [node.plan()] if "QueryStage" in name else [node.children().apply(i) for i in range(node.children().size())]
        return sum(walk(k) for k in kids)

    return walk(plan)


def test_bucketed_table_skips_row_groups_and_reopens(spark, tmp_path):
    path = str(tmp_path / "b x")
    rows = spark.range(40_000).select(F.concat(F.lit("e"), F.col("id") % 4000).alias("entity"), F.col("id").alias("v"))
    old = spark.conf.get("parquet.block.size", None)
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "20000")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.page.row.count.limit", "100")
    try:
        write_bucketed(rows, path, "entity", "v", buckets=2)
    finally:
        for k in ("parquet.block.size", "parquet.page.row.count.limit"):
            spark.sparkContext._jsc.hadoopConfiguration().unset(k)
    assert old is None
    fresh = spark.newSession()
    for session in (spark, fresh):
        table = read_bucketed(session, path)
        one = table.where("entity = 'e17'")
        assert scanned_rows(one) < 5_000
        assert sorted(r.v for r in one.collect()) == list(range(17, 40_000, 4000))
        plan = table.groupBy("entity").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    assert len([f for f in (tmp_path / "b x").iterdir() if f.name.startswith("part-")]) == 2
    meta = pq.ParquetFile(next(f for f in (tmp_path / "b x").iterdir() if f.name.startswith("part-"))).metadata
    assert meta.num_row_groups > 3
    write_bucketed(rows.limit(10), path, "entity", buckets=3)
    assert read_bucketed(spark, path).count() == 10


def test_numbered_text_lines_are_not_moved(spark, tmp_path):
    """The splits go to the lines, however small a broadcast Spark would choose by itself."""
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("v\n" + "".join(f"{name}{i}\n" for i in range(50)))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        df = read_csv(spark, str(tmp_path), "v string", line_no="n")
        rows = df.orderBy("n").collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert [r.v for r in rows] == [f"{name}{i}" for name in "ab" for i in range(50)]
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan

"""Run a query and its SQL on the same files and compare whole results.

    python -m checks.compare [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: str = "8", partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v: object) -> object:
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    started = time.time()
    mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if name not in ORACLE:
        return len(mine) > 0, f"{len(mine)} rows, no SQL, {took:.2f}s"
    res = con.execute(ORACLE[name])
    columns = [c[0] for c in res.description]
    theirs = _sorted_rows(columns, res.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if mine != theirs:
        differing = [(a, b) for a, b in zip(mine, theirs) if a != b][:2]
        return False, f"{len(mine)} vs {len(theirs)} rows; {differing}"
    return True, f"{len(mine)} rows, {took:.2f}s"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = [n for n in QUERIES if len(sys.argv) < 3 or any(n.startswith(p) for p in sys.argv[2:])]
    spark, con = session(), database(sf_dir)
    bad = 0
    for name in wanted:
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} match")


if __name__ == "__main__":
    main()

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


LINES = (
    "entity string, name string, period int, grp string, league string, source int, line_no long, "
    "measure decimal(12,4), cost long, category string"
)


@pytest.fixture(scope="session")
def make_lines(spark):
    """Lines from (entity, name, period, grp, source, measure[, cost[, category[, league]]]) rows, numbered in order."""
    from decimal import Decimal

    def make(rows):
        numbers = {}
        out = []
        for r in rows:
            entity, name, period, grp, source, measure, *rest = r
            numbers[source] = numbers.get(source, 0) + 1
            cost = rest[0] if len(rest) > 0 else 0
            category = rest[1] if len(rest) > 1 else None
            league = rest[2] if len(rest) > 2 else "AL"
            m = None if measure is None else Decimal(str(measure))
            out.append((entity, name, period, grp, league, source, numbers[source], m, cost, category))
        return spark.createDataFrame(out, LINES)

    return make

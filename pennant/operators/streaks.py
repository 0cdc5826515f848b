"""Longest runs of consecutive seasons that meet a threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import asc_last, desc_last, first_seen, joined, year_span
from pennant.operators.leaders import top_n
from pennant.operators.rollups import seasons


def islands(df: DataFrame, keys: list[str], order: str, condition: Column, alias: str = "island") -> DataFrame:
    """Tag runs of consecutive rows (in ``order``, per key) that meet ``condition``.

    The tag is equal within a run and differs between runs; rows that do not meet it get null.
    """
    by = Window.partitionBy(*keys).orderBy(order)
    hit = F.coalesce(condition, F.lit(False))
    ordinal = F.row_number().over(by)
    among_hits = F.row_number().over(Window.partitionBy(*keys, "_hit").orderBy(order))
    return (
        df.withColumn("_hit", hit)
        .withColumn("_ordinal", ordinal)
        .withColumn(alias, F.when(F.col("_hit"), F.col("_ordinal") - among_hits))
        .drop("_hit", "_ordinal")
    )


def longest_streak(lines: DataFrame, threshold: object, n: int, *, keep_zero: bool = True) -> DataFrame:
    """Entities with the longest run of seasons over ``threshold``.

    Consecutive means next to each other in the entity's own list of seasons: a missed period does not
    end a run. Between equal runs the higher total wins, then the earlier. ``keep_zero`` also ranks
    entities that never got over the threshold, with length 0.
    """
    whole = Window.partitionBy("entity")
    book = seasons(lines, by_entity=True).withColumns(
        {
            "entity_name": F.min_by("name", "first_line").over(whole),
            "entity_line": F.min("first_line").over(whole),
        }
    )
    tagged = islands(book, ["entity"], "first_line", F.col("total") > threshold)
    hit = F.col("island").isNotNull()
    runs = tagged.groupBy("entity", "island").agg(
        F.first("entity_name").alias("name"),
        F.min("entity_line").alias("entity_line"),
        F.count(F.when(hit, 1)).alias("length"),
        F.sum(F.when(hit, F.col("total"))).alias("run_total"),
        F.min(F.when(hit, F.col("period"))).alias("lo"),
        F.max(F.when(hit, F.col("period"))).alias("hi"),
        F.min("first_line").alias("run_line"),
        F.flatten(F.collect_list(F.when(hit, F.col("sightings")))).alias("seen"),
    )
    orders = [desc_last("length"), desc_last("run_total"), asc_last("run_line")]
    place = F.row_number().over(Window.partitionBy("entity").orderBy(*orders))
    best = runs.withColumn("_place", place).where(F.col("_place") == 1)
    if not keep_zero:
        best = best.where(F.col("length") > 0)
    top = top_n(best, [desc_last("length"), asc_last("entity_line")], n)
    groups = F.when(F.col("length") > 0, joined(first_seen("seen", "grp")))
    return top.select("entity", "name", F.col("length").alias("periods"), year_span("lo", "hi").alias("span"), groups.alias("groups"))

"""Mixing sources to target weights by entropy balancing.

Of all document rates with a source's token count at its target, the balanced ones have the least entropy relative to
taking every document once, with no rate above ``CAP``. They are ``min(CAP, exp(tilt * size))`` with one tilt per
source, the root of a convex dual's slope. Newton steps find all tilts together: each step is one aggregation over the
distinct (source, size) pairs, not over the documents. Rates are then rounded into whole copies so that what is left over
at one size is made up for at smaller ones.

Everything is DataFrame code. Sums that decide a result are sums of decimals, so that a rerun gives the same bits
whatever the order of its tasks. A hot source is as many rows as it has distinct sizes; copies are dealt out among its
documents in portions of some ``PORTION`` rows. Rows that are equal in all three columns are one row with a count until
the end.

Nulls: a null source is a source of its own, the last; a null text has no words; a null id is an id like others.
Documents without words are never taken. A source without words has the target 0. An empty table has no rows. Columns
other than the three that are named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import sums_before
from pennant.llm.common import Space, key_of, repeated
from pennant.operators.ranking import numbered

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # of all sizes
CAP = 2  # times a source's or a document's size
PORTION = 64
FINE = 6  # sizes of one bucket agree in so many bits below the first
EXACT = "decimal(38,6)"
WORDS = r"[^\x20\x09-\x0D]+"


def exact_sum(c: Column) -> Column:
    return F.sum(c.cast(EXACT)).cast("double")


def bucket(size: Column) -> Column:
    """Grows with the size; sizes of one bucket differ by one part in 2**FINE at most, those below 2**FINE not at all."""
    high = F.length(F.bin(size)) - 1
    return F.when(size < 1 << FINE, size).otherwise(
        F.shiftleft(high.cast("long"), FINE) + F.call_function("shiftright", size, (high - FINE).cast("int"))
    )


def targets(sources: DataFrame, space: Space, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE) -> DataFrame:
    """(key, source, source_size, target): weights in the order of the sources, null last, and the excess of those that
    reach the cap dealt out by weight among the others, until none is above. Only sums over all sources reach the
    driver; each round caps one source more at least."""
    ranked = numbered(sources, [F.col("source").asc_nulls_last()])
    listed = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(listed, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("long")
    book = space.write(ranked.select("key", "source", "source_size", weight.alias("weight")), "weights")
    total = book.agg(F.sum("source_size")).first()[0] or 0
    level, most = None, CAP * F.col("source_size")
    while True:
        full = F.lit(False) if level is None else most.cast("double") <= F.col("weight") * F.lit(level)
        held, free = book.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            break
        now = (total * share[0] / share[1] - (held or 0)) / free
        if now == level:
            break
        level = now
    target = F.least(most.cast("double"), F.col("weight") * F.lit(level)) if level is not None else most.cast("double")
    return space.write(book.select("key", "source", "source_size", target.alias("target")), "targets")


def rate(tilt: Column, size: Column) -> Column:
    """Tilted rate; a null tilt stands for the limit, the cap."""
    return F.coalesce(F.least(F.lit(float(CAP)), F.exp(tilt * size)), F.lit(float(CAP)))


def tilts(sizes: DataFrame, goals: DataFrame, space: Space, rounds: int = 200) -> DataFrame:
    """(key, tilt) of every source with words. ``sizes``: written (key, size, n); ``goals``: (key, source_size, target).

    Newton steps on the logarithm of the tokens, which is convex below a rate of 1: from 0 they go down to the root
    without passing it. Above, the cap flattens it, and a step that leaves the bracket is replaced by its middle; the
    bracket ends where the smallest document reaches the cap. It halves at least once in two rounds, so that 200
    rounds are more than a double has digits.
    """
    least = sizes.groupBy("key").agg(F.min("size").alias("least"))
    wanted = goals.where(F.col("target") > 0).join(least, "key")
    none = F.lit(None).cast("double")
    full = F.col("target") >= CAP * F.col("source_size")
    state = space.write(
        wanted.select(
            "key", "target", F.when(~full, F.lit(0.0)).alias("tilt"), F.lit(float("-inf")).alias("low"),
            F.when(F.col("target") > F.col("source_size"), F.log(F.lit(float(CAP))) / F.col("least")).otherwise(0.0).alias("high"),
            full.alias("done"),
        ),
        "tilts",
    )
    for _ in range(rounds):
        open_ = state.where(~F.col("done"))
        if open_.limit(1).count() == 0:
            break
        size, n = F.col("size").cast("double"), F.col("n").cast("double")
        tilted = F.exp(F.col("tilt") * size)
        sums = sizes.join(open_.select("key", "tilt"), "key").groupBy("key").agg(
            exact_sum(n * size * F.least(F.lit(float(CAP)), tilted)).alias("tokens"),
            exact_sum(F.when(tilted < CAP, n * size * size * tilted).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("tokens") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.log(F.col("tokens") / F.col("target")) * F.col("tokens") / F.when(F.col("slope") > 0, F.col("slope"))
        middle = F.when(low > float("-inf"), (low + high) / 2).otherwise(high * 2 - 1e-9)
        stepped = F.when((newton > low) & (newton < high), newton).otherwise(middle)
        settled = (F.abs(gap) <= F.greatest(F.lit(1e-3), F.col("target") * 1e-9)) | (low >= high)
        moved = state.join(sums, "key", "left").select(
            "key", "target",
            F.when(F.col("done") | settled, F.col("tilt")).otherwise(stepped).alias("tilt"),
            F.when(F.col("done"), none).otherwise(low).alias("low"), F.when(F.col("done"), none).otherwise(high).alias("high"),
            (F.col("done") | settled).alias("done"),
        )
        state = space.write(moved, "tilts")
    return state.select("key", "target", "tilt")


def copies_per_bucket(buckets: DataFrame) -> DataFrame:
    """(key, bucket, n, copies): whole copies per bucket, from the largest sizes down, nearest to what the rates want.

    What a bucket takes too much or too little is carried on to the next smaller one; a choice that the rest could no
    longer make up for is avoided. A source is one row here: its buckets are at most 64 per power of two.
    """
    entry = F.struct("bucket", "n", F.col("tokens").cast("double").alias("tokens"), "wanted")
    whole = buckets.groupBy("key").agg(F.min("target").alias("target"), F.sort_array(F.collect_list(entry), asc=False).alias("entries"))

    def total(field: str) -> Column:
        return F.aggregate("entries", F.lit(0.0), lambda s, x: s + x[field])

    start = F.struct(
        (F.col("target") - total("wanted")).alias("carry"), total("wanted").alias("want_below"), total("tokens").alias("below"),
        F.array().cast("array<struct<bucket:bigint,n:bigint,copies:bigint>>").alias("picks"),
    )

    def step(s: Column, x: Column) -> Column:
        mean, due = x["tokens"] / x["n"], x["wanted"] + s["carry"]
        want, rest = s["want_below"] - x["wanted"], s["below"] - x["tokens"]
        least, most = F.ceil((due + want - CAP * rest) / mean), F.floor((due + want) / mean)
        near = F.when(least <= most, F.greatest(least, F.least(most, F.round(due / mean).cast("long")))).otherwise(
            F.round((due + want - rest) / mean).cast("long")
        )
        taken = F.greatest(F.lit(0).cast("long"), F.least(near.cast("long"), CAP * x["n"]))
        pick = F.struct(x["bucket"].alias("bucket"), x["n"].alias("n"), taken.alias("copies"))
        return F.struct(
            (due - taken * mean).alias("carry"), want.alias("want_below"), rest.alias("below"), F.concat(s["picks"], F.array(pick)).alias("picks")
        )

    picks = F.aggregate("entries", start, step, lambda s: s["picks"])
    return whole.select("key", F.inline(picks))


def up_to(place: str, copies: str, n: str) -> Column:
    """Copies among the first ``place`` of n rows that share ``copies``, spread evenly; exact beyond 64 bits."""
    return F.expr(f"cast({place} as decimal(19,0)) * cast({copies} as decimal(19,0)) div cast({n} as decimal(19,0))")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and rate per document.

    ``taken`` is copies times size; copies are 0 to 2. Documents of one size have the same rate, and copies go round
    among those of nearly one size in the order of a hash of their ids.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), size.alias("size"))
    with Space(spark) as space:
        units = rows.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
        units = space.write(units.withColumns({"key": key_of(F.col("source")), "bucket": bucket(F.col("size"))}), "units", keep=True)
        sizes = space.write(units.groupBy("key", "source", "size", "bucket").agg(F.sum("m").alias("n")), "sizes")
        sources = sizes.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
        goals = targets(sources, space, weights, share)
        some = sizes.where("size > 0")
        found = space.write(tilts(some, goals, space), "found")
        each = some.join(found, "key").withColumn("rate", rate(F.col("tilt"), F.col("size").cast("double")))
        buckets = each.groupBy("key", "bucket", "target").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("tokens"),
            exact_sum(F.col("n").cast("double") * F.col("size") * F.col("rate")).alias("wanted"),
        )
        buckets = space.write(copies_per_bucket(buckets), "buckets")
        portion = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / PORTION))
        dealt = space.write(units.where("size > 0").join(buckets, ["key", "bucket"]).withColumn("portion", portion), "dealt", keep=True)
        keys = ["key", "bucket", "portion"]
        portions = dealt.groupBy(*keys, "n", "copies").agg(F.sum("m").alias("rows"))
        portions = sums_before(space.write(portions, "portions"), ["key", "bucket"], "portion", "rows", (12, 16)).withColumn("end", F.col("start") + F.col("rows"))
        portions = space.write(
            portions.select(*keys, "rows", (up_to("end", "copies", "n") - up_to("start", "copies", "n")).alias("share")), "portions", keep=True
        )
        tilted = found.select("key", "tilt", F.lit(True).alias("tilted"))
        books = space.write(goals.select("key", "source_size", "target").join(tilted, "key", "left"), "books", keep=True)
    run = Window.partitionBy(*keys).orderBy("size", F.col("id").asc_nulls_first())
    upto = F.sum("m").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = dealt.select(*keys, "id", "size", "m", upto.alias("upto")).join(portions, keys).withColumn("from", F.col("upto") - F.col("m"))
    placed = placed.withColumn("all", up_to("upto", "share", "rows") - up_to("from", "share", "rows"))
    placed = placed.select("key", "id", "size", "m", "all")
    unsized = units.where("size = 0").select("key", "id", "size", "m", F.lit(0).cast("long").alias("all"))
    out = repeated(placed.unionByName(unsized), "m", "copy")
    out = out.withColumn("copies", F.expr("all div m") + (F.col("copy") < F.col("all") % F.col("m")).cast("long"))
    return out.join(books, "key").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies",
        F.when((F.col("size") > 0) & F.col("tilted"), rate(F.col("tilt"), F.col("size").cast("double"))).otherwise(0.0).alias("rate"),
    )

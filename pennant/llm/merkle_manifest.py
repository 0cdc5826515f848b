"""Merkle manifest of a table of documents: digests, proofs and their check.

A document's place among the documents of its source comes from bitmaps instead of a sort: the ids of a source are
bits of 64-bit words (only words with a bit are stored), ``sums_before`` adds the words' counts up in directories,
and a document's place is its word's start plus the number of lower bits in the word. Nodes then meet their siblings
by (source, place / 16), as arrays with a slot per sibling, level by level.

Every step is keyed: no source, run of ids or level has to fit into one task. A group holds 16 nodes, a window the
words below one directory entry. Levels are written, so that a lost executor costs one level's tasks.

Nulls: a null source is a source of its own, the first; a null id sorts before all others. Rows with the same id stand
in the order of their leaves; equal rows are as many leaves. An empty table has no rows, hence no root. Texts may be of
any length. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import sums_before
from pennant.llm.common import Space, fold, key_of, remainder, repeated
from pennant.operators.ranking import numbered

FAN = 16
SHIFT = 4  # log2 of FAN
WORD = 6  # bits of an id inside a word
DIRECTORIES = (10, 16, 16)
NO_ID = -(1 << (63 - WORD)) - 1  # the word of null ids, before that of the smallest id
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Digest of a row: each value as its length in bytes, ``:`` and itself, or ``-`` for null."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return h(*[part(c) for c in columns])


def _depth(n: Column) -> Column:
    """Levels above n leaves: how many powers of FAN are below n."""
    return sum(((n > FAN**k).cast("int") for k in range(16)), F.lit(0))


def places(rows: DataFrame, space: Space) -> DataFrame:
    """``rows`` (forest, id, leaf and others) with ``pos``, from 0 within the forest, and ``n``, the forest's size."""
    low = F.coalesce(F.col("id").bitwiseAND((1 << WORD) - 1), F.lit(0)).cast("int")
    keyed = rows.withColumns({"word": F.coalesce(F.shiftright("id", WORD), F.lit(NO_ID)), "low": low})
    words = keyed.groupBy("forest", "word").agg(F.bit_or(F.expr("shiftleft(1L, low)")).alias("bits"), F.count(F.lit(1)).alias("rows"))
    words = sums_before(space.write(words, "words"), ["forest"], "word", "rows", DIRECTORIES)
    words = space.write(words, "starts")
    lower = F.col("bits").bitwiseAND(F.bitwise_not(F.expr("shiftleft(-1L, low)")))
    placed = keyed.join(words.select("forest", "word", "bits", "start", F.col("total").alias("n"), "rows"), ["forest", "word"])
    placed = placed.withColumn("pos", F.col("start") + F.bit_count(lower))
    again = F.col("rows") > F.bit_count("bits")
    if words.where(again).limit(1).count() == 0:
        return placed.select(*rows.columns, "pos", "n")
    return placed.where(~again).select(*rows.columns, "pos", "n").unionByName(_with_repeats(rows, placed.where(again), space))


def _with_repeats(rows: DataFrame, placed: DataFrame, space: Space) -> DataFrame:
    """Places in words that hold an id more than once: ids by their counts, then leaves by theirs, then their copies."""
    others = [c for c in rows.columns if c not in ("forest", "id", "leaf")]
    same = ["forest", "word", "low"]
    units = placed.groupBy(*same, "id", "leaf", "start", "n").agg(F.count(F.lit(1)).alias("copies"), *[F.min(c).alias(c) for c in others])
    units = space.write(units.withColumn("head", F.conv(F.substring("leaf", 1, 4), 16, 10).cast("long")), "units")
    ids = space.write(units.groupBy(*same).agg(F.sum("copies").alias("m")), "ids")
    lower = Window.partitionBy("forest", "word").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    ids = ids.withColumn("ahead", F.coalesce(F.sum("m").over(lower), F.lit(0))).drop("m")
    heads = space.write(units.groupBy(*same, "head").agg(F.sum("copies").alias("m")), "heads")
    heads = sums_before(heads, same, "head", "m", (8,)).select(*same, "head", F.col("start").alias("first"))
    near = Window.partitionBy(*same, "head").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("here", F.coalesce(F.sum("copies").over(near), F.lit(0))).join(ids, same).join(heads, [*same, "head"])
    each = repeated(units, "copies", "copy")
    return each.withColumn("pos", F.col("start") + F.col("ahead") + F.col("first") + F.col("here") + F.col("copy")).select(*rows.columns, "pos", "n")


def levels_of(nodes: DataFrame, space: Space) -> tuple[list[DataFrame], DataFrame]:
    """Levels of all forests, and (forest, depth, digest) of what remains of each.

    ``nodes``: a written table (forest, pos, depth, digest, load). A level's row is a node with its children's array.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    levels, tops = [], [nodes.where("depth = 0").select("forest", "depth", "digest")]
    here = nodes
    for k in range(1, deepest + 1):
        slot = F.struct(F.col("pos").bitwiseAND(FAN - 1).alias("slot"), "digest", *(["load"] if k == 1 else []))
        runs = here.where(F.col("depth") >= k).groupBy("forest", "depth", F.shiftright("pos", SHIFT).alias("pos"))
        runs = runs.agg(F.sort_array(F.collect_list(slot)).alias("kids"))
        joined = F.array_join(F.transform("kids", lambda x: x["digest"]), "")
        here = space.write(runs.withColumn("digest", h(joined)), f"level{k}", keep=True)
        levels.append(here)
        tops.append(here.where(F.col("depth") == k).select("forest", "depth", "digest"))
    return levels, reduce(DataFrame.unionByName, tops)


def paths(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """(forest, digest, load, path, carried) per node; a path has (left, right), the siblings' digests, from the bottom.

    ``tops``: (forest, depth, path, carried), the path from the forest's own root upwards.
    """
    none = tops.where("depth = 0").select("forest", "path", *carried)
    alone = nodes.where("depth = 0").select("forest", "digest", "load").join(none, "forest").select("forest", "digest", "load", "path", *carried)
    here = None
    for k in range(len(levels), 0, -1):
        own = tops.where(F.col("depth") == k).select("forest", F.lit(0).cast("long").alias("pos"), "path", *carried)
        here = own if here is None else here.unionByName(own)
        digests = F.transform("kids", lambda x: x["digest"])

        def step(kid: Column, i: Column) -> Column:
            left = F.array_join(F.slice(digests, F.lit(1), i), "")
            right = F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "")
            return F.struct(kid["slot"].alias("slot"), kid["digest"].alias("digest"), *([kid["load"].alias("load")] if k == 1 else []), left.alias("left"), right.alias("right"))

        kids = levels[k - 1].select("forest", "pos", F.transform("kids", step).alias("kids"))
        each = here.join(kids, ["forest", "pos"]).select("forest", "pos", "path", *carried, F.explode("kids").alias("kid"))
        path = F.concat(F.array(F.struct("kid.left", "kid.right")), "path").alias("path")
        if k == 1:
            return each.select("forest", "kid.digest", "kid.load", path, *carried).unionByName(alone)
        here = each.select("forest", (F.shiftleft("pos", SHIFT) + F.col("kid.slot")).alias("pos"), path, *carried)
    return alone


def proofs(leaves: DataFrame, space: Space) -> DataFrame:
    """(id, leaf, subroot, root, path, load) per row of ``leaves`` (forest, id, leaf, load).

    Forests are the sources: a tree each, and a tree over their roots in the order of the forests' names.
    """
    leaves = space.write(leaves, "leaves")
    nodes = places(leaves, space).select(
        "forest", "pos", _depth(F.col("n")).alias("depth"), F.col("leaf").alias("digest"), F.struct("id", "load").alias("load")
    )
    nodes = space.write(nodes, "nodes", keep=True)
    levels, subroots = levels_of(nodes, space)
    subroots = space.write(subroots, "subroots", keep=True)
    n = subroots.count()
    ordered = numbered(subroots.select("forest", "digest"), [F.col("forest").asc()])
    upper = ordered.select(
        F.lit("").alias("forest"), (F.col("rank") - 1).alias("pos"), _depth(F.lit(n)).alias("depth"), "digest", F.col("forest").alias("load")
    )
    upper = space.write(upper, "sources", keep=True)
    upper_levels, root = levels_of(upper, space)
    empty = F.array().cast("array<struct<left:string,right:string>>")
    root = root.select("forest", "depth", F.col("digest").alias("root"), empty.alias("path"))
    tops = paths(upper, upper_levels, root, ["root"])
    tops = tops.select(F.col("load").alias("forest"), F.col("digest").alias("subroot"), "path", "root")
    tops = space.write(tops.join(subroots.select("forest", "depth"), "forest"), "tops", keep=True)
    found = paths(nodes, levels, tops, ["subroot", "root"])
    return found.select(F.col("load.id").alias("id"), F.col("digest").alias("leaf"), "subroot", "root", "path", F.col("load.load").alias("load"))


def proof_digest(path: str = "path") -> Column:
    """Digest of all siblings on the way up, left to right."""
    return h(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda x, p: h(p["left"], x, p["right"]))


def manifest(docs: DataFrame, claimed: Column | None = None, columns: Sequence[str] = LEAF_COLUMNS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 per document, and the check of what somebody claims its leaf to be:
    folded_root and verified. ``claimed`` is a leaf computed from the documents' columns; null claims nothing else
    than the leaf itself.
    """
    id_col, source = columns[0], columns[1]
    claimed = F.lit(None).cast("string") if claimed is None else claimed
    leaves = docs.select(
        key_of(F.col(source)).alias("forest"), F.col(id_col).cast("long").alias("id"),
        leaf_digest([F.col(c) for c in columns]).alias("leaf"), claimed.alias("load"),
    )
    with Space(docs.sparkSession) as space:
        found = proofs(leaves, space)
    checked = found.withColumn("folded_root", folded(F.coalesce("load", "leaf")))
    return checked.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """The manifest, checked against rows of which some have their text's A-Z in lower case."""
    others = [F.col(c) for c in LEAF_COLUMNS[:-1]]
    altered = leaf_digest([*others, fold(F.col("text"))])
    return manifest(docs, F.when(remainder(F.col("doc_id"), 5) == 0, altered))

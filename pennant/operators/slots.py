"""Positions among the lines that a filter kept.

``line_no`` is a line's position in its file as stored. Some orders go by the position among the lines that count instead:
the first kept line of each source is 1, whatever was dropped before it. That position is only needed for the first line of
each stint, so the lines themselves are not moved: they become bits of 64-bit words by (source, line number), combined
map-side, and the words' counts are added up in directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.functions import sums_before
from pennant.operators.rollups import stints, stored_stints
from pennant.sources.checkpoints import cut_lineage
from pennant.sources.lines import MAX_SOURCES, SOURCE_BITS

WORD = 6  # bits of a line number inside a word
DIRECTORIES = (10, 16, 16)


def kept_words(lines: DataFrame) -> DataFrame:
    """(source, word, bits, start): which line numbers are there, and how many are there before the word."""
    bit = F.expr("shiftleft(1L, cast(line_no & 63 as int))")
    words = lines.groupBy("source", F.shiftright("line_no", WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))
    words = cut_lineage(words.withColumn("n", F.bit_count("bits").cast("long")))
    return sums_before(words, ["source"], "word", "n", DIRECTORIES).select("source", "word", "bits", "start")


def kept_stints(lines: DataFrame) -> DataFrame:
    """Stints per source whose ``first_slot`` follows the position among the given lines, sources interleaved.

    Give the result to the operators in place of the lines, with the group order ``slot``. Stored stints are what this
    returns already, if they were made by it.
    """
    per_source = stored_stints(lines)
    place = F.col("first_line").bitwiseAND((1 << SOURCE_BITS) - 1)
    keyed = per_source.withColumns({"word": F.shiftright(place, WORD), "_bit": place.bitwiseAND((1 << WORD) - 1).cast("int")})
    upto = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.expr("shiftleft(-1L, _bit)"))))
    slot = (F.col("start") + upto + 1) * MAX_SOURCES + F.col("source")
    return keyed.join(kept_words(lines), ["source", "word"]).withColumn("first_slot", slot).select(*per_source.columns)


def slotted(lines: DataFrame, group_order: str) -> tuple[DataFrame, str]:
    """Lines or stints, and the group order to roll them up with, for an order that may be ``kept``."""
    if group_order != "kept":
        return lines, group_order
    return (lines if "n_lines" in lines.columns else kept_stints(lines)), "slot"

"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units and names are typed placeholders, other words lose their case and
outer punctuation. Windows of template tokens are joined by hash with those of the benchmark. Along each alignment
of a text with an item the placeholders' values must map one to one; a text that covers enough of an item's
windows with consistent slots holds the item, re-parameterised or as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pennant.llm.common import Space, numbered
from pennant.llm.words import EXACT, U, chunks, mix, prefix_sums, spans

WINDOW = 5  # template tokens
SHARE = 0.5  # of an item's windows that a text must hold
FILTER_BITS = 1 << 23  # of the filter sent to every task: 1 MB, whatever the benchmark's size

# Measuring units, with plurals and signs.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonne "
    "tonnes ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years metre metres meter meters kilometre kilometres kilometer kilometers centimetre centimetres dollar dollars euro euros "
    "pound pounds cent cents percent degree degrees watt watts kw kwh v volt volts hz mph kmh kph % $ € £ °c °f".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?(?:\d+(?:[.,:/]\d+)*)(?:st|nd|rd|th)?(?P<unit>%|[a-z°]{1,4})?")
_NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half".split()
)
_EDGE = re.compile(r"^[^\w%$€£°+-]+|[^\w%$€£°]+$")
_CLOSES = re.compile(r"[.!?:;。][\"')\]]*$")
_STEPS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64))
MEMORY_BYTES = 8 << 20  # of distinct odd words that a task remembers

# Classes of bytes: letters of ASCII and Latin-1 (after 0xC3 in UTF-8) whose case can be told byte by byte, signs that stay
# at a word's end, punctuation that goes.
_UPPER, _LOWER = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = _LOWER[ord("a") : ord("z") + 1] = True
_UPPER_2, _LOWER_2 = np.zeros(256, bool), np.zeros(256, bool)  # second bytes; the signs for times and division are no letters
_UPPER_2[0x80:0x9F], _LOWER_2[0x9F:0xC0] = True, True
_UPPER_2[0x97] = _LOWER_2[0xB7] = False
_SIGN, _GOES, _GOES_FIRST = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_SIGN[[ord("%"), ord("$")]] = True
_GOES_FIRST[[ord(c) for c in "!\"#&'()*,./:;<=>?@[\\]^`{|}~"]] = True
_GOES[:] = _GOES_FIRST
_GOES[[ord("+"), ord("-")]] = True
_STOP, _AFTER_STOP = np.zeros(256, bool), np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;"]] = True
_AFTER_STOP[[ord(c) for c in "\"')]"]] = True


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per byte range."""
    sums, inverse = prefix_sums(raw, EXACT)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def plain_hashes(tokens: list[str]) -> np.ndarray:
    data = [t.encode() for t in tokens]
    edge = np.cumsum([0] + [len(d) for d in data])
    return hashes(np.frombuffer(b"".join(data), np.uint8), edge[:-1], edge[1:])


NUM, UNIT, NAME = (int(x) for x in plain_hashes(["<num>", "<unit>", "<name>"]))
_UNIT_HASHES, _NUMBER_HASHES = np.sort(plain_hashes(sorted(UNITS))), np.sort(plain_hashes(sorted(_NUMBER_WORDS)))


def word_class(word: str) -> tuple[str, int, bool]:
    """(value, empty for punctuation alone; placeholder it may be, or 0; whether it ends a sentence)."""
    core = _EDGE.sub("", word)
    low = core.lower()
    number = _NUMBER.fullmatch(low)
    if not low:
        kind = 0
    elif number and (not number["unit"] or number["unit"] in UNITS) or low in _NUMBER_WORDS:
        kind = NUM
    elif low in UNITS:
        kind = UNIT
    else:
        kind = NAME if len(core) > 1 and core[0].isupper() and not core.isupper() else 0
    return low, kind, bool(_CLOSES.search(word))


class Words:
    """Classes of words. Words of plain letters, with punctuation around them, are told by arrays; any other word is looked at
    once and remembered by the hash of its bytes, until its task's memory has grown to MEMORY_BYTES."""

    def __init__(self) -> None:
        self.at: dict[int, tuple[int, int, bool]] = {}
        self.bytes = 0

    def classes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(plain hash, or 0 for punctuation alone; kind; closes) per word of a line of bytes."""
        if not len(starts):
            none = np.zeros(0, np.uint64)
            return none, none.copy(), np.zeros(0, bool)
        lead = np.zeros(len(raw), bool)
        lead[:-1] = raw[:-1] == 0xC3
        second = np.zeros(len(raw), bool)
        second[1:] = lead[:-1]
        upper, lower = _UPPER[raw] | (second & _UPPER_2[raw]), _LOWER[raw] | (second & _LOWER_2[raw])
        letter = upper | lower
        letter[:-1] |= lead[:-1] & letter[1:] & second[1:]
        folded = raw + (upper * np.uint8(32))
        # a plain word: punctuation that goes, letters, signs, punctuation that goes
        at = np.arange(len(raw) + 1)
        first = np.minimum.accumulate(np.where(letter, at[:-1], len(raw))[::-1])[::-1][starts]
        last = np.maximum.accumulate(np.where(letter, at[:-1], -1))[ends - 1]
        known = (first < ends) & (last >= starts)
        first, last = np.where(known, first, starts), np.where(known, last, starts)
        sign_end = np.minimum.accumulate(np.where(_SIGN[raw], len(raw), at[:-1])[::-1])[::-1]  # the next byte that is no sign
        sign_end = np.append(sign_end, len(raw))
        stop = np.minimum(sign_end[last + 1], ends)

        def all_of(mask: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            count = np.concatenate([[0], np.cumsum(mask)])
            return count[high] - count[low] == high - low

        known &= all_of(_GOES_FIRST[raw], starts, first) & all_of(letter, first, last + 1) & all_of(_GOES[raw], stop, ends)
        plain = np.zeros(len(starts), np.uint64)
        kind, closes = np.zeros(len(starts), np.uint64), np.zeros(len(starts), bool)
        # letters: hash, case, lists
        a, z = first[known], stop[known]
        h = hashes(folded, a, z)
        ups, lows = np.concatenate([[0], np.cumsum(upper)]), np.concatenate([[0], np.cumsum(lower)])
        one = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters
        n_up, n_low = ups[z] - ups[a], lows[z] - lows[a]
        begins = ups[a + 1] - ups[a] + (lead[a] & (ups[np.minimum(a + 2, len(raw))] > ups[a]))
        named = (one[z] - one[a] > 1) & (begins > 0) & ~((n_low == 0) & (n_up > 0))
        k = np.where(named, U(NAME), U(0))
        k[_in(h, _UNIT_HASHES)] = UNIT
        k[_in(h, _NUMBER_HASHES)] = NUM
        plain[known], kind[known] = h, k
        tail = ends[known] - 1
        while (moving := _AFTER_STOP[raw[tail]]).any():
            tail = tail - moving
        closes[known] = _STOP[raw[tail]]
        # any other word
        odd = np.flatnonzero(~known)
        if len(odd):
            if self.bytes > MEMORY_BYTES:
                self.__init__()
            names, where, which = np.unique(hashes(raw, starts[odd], ends[odd]), return_index=True, return_inverse=True)
            new = [i for i, name in enumerate(names.tolist()) if name not in self.at]
            words = [raw[starts[odd[where[i]]] : ends[odd[where[i]]]].tobytes().decode() for i in new]
            found = [word_class(w) for w in words]
            for i, w, c, p in zip(new, words, found, plain_hashes([c[0] for c in found]).tolist() if found else []):
                self.at[int(names[i])] = (p if c[0] else 0, c[1], c[2])
                self.bytes += 200
            rows = [self.at[name] for name in names.tolist()]
            plain[odd] = np.asarray([r[0] for r in rows], np.uint64)[which]
            kind[odd] = np.asarray([r[1] for r in rows], np.uint64)[which]
            closes[odd] = np.asarray([r[2] for r in rows], bool)[which]
        return plain, kind, closes


def _in(h: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return listed[np.minimum(np.searchsorted(listed, h), len(listed) - 1)] == h


def templates(raw: np.ndarray, at: np.ndarray, words: Words) -> tuple[np.ndarray, ...]:
    """(token hash, plain hash, row, start, end) of a line of texts; a token that is its plain hash is no slot.

    A capitalised word inside a sentence is a name, at a sentence's start a plain word. A unit follows a number. Words that are
    punctuation alone are left out.
    """
    starts, ends, row = spans(raw, at)
    plain, kind, closes = words.classes(raw, starts, ends)
    opening = np.ones(len(row), bool)
    opening[1:] = closes[:-1] | (row[1:] != row[:-1])
    kind[(kind == U(NAME)) & opening] = 0
    keep = plain != 0
    plain, kind, row, starts, ends = plain[keep], kind[keep], row[keep], starts[keep], ends[keep]
    after_number = np.zeros(len(row), bool)
    after_number[1:] = (kind[:-1] == U(NUM)) & (row[1:] == row[:-1])
    kind[(kind == U(UNIT)) & ~after_number] = 0
    return np.where(kind != 0, kind, plain), plain, row, starts, ends


def window_hashes(tokens: np.ndarray, plains: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first token, number of tokens) per window; a shorter text is one window of all its tokens, no token gives none.

    A window of placeholders alone says nothing (any table of numbers has it), so it stands by its values.
    """
    n = len(tokens)
    none = np.zeros(0, np.int64)
    if not n:
        return none.astype(np.uint64), none, none
    edge = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]]))
    left = np.repeat(edge[1:], np.diff(edge)) - np.arange(n)  # tokens from here to the text's end
    size = np.repeat(np.diff(edge), np.diff(edge))
    first = np.flatnonzero((left >= WINDOW) | ((size < WINDOW) & (left == size)))
    width = np.minimum(left[first], WINDOW)
    shown = np.concatenate([[0], np.cumsum(tokens == plains)])
    bare = shown[first + width] == shown[first]
    out = width.astype(np.uint64)
    for j in range(WINDOW):
        here = first + np.minimum(j, width - 1)
        step = mix(out + np.where(bare, plains[here], tokens[here]) * _STEPS[j])
        out = np.where(j < width, step, out)
    return out, first, width


class Filter:
    """A Bloom filter of window hashes with four probes: no hash that was put in is ever missed."""

    def __init__(self) -> None:
        self.bits = np.zeros(FILTER_BITS // 8, np.uint8)

    def _probes(self, h: np.ndarray) -> Iterator[np.ndarray]:
        step = mix(h) | U(1)
        for j in range(4):
            yield ((h + step * U(j)) & U(FILTER_BITS - 1)).astype(np.int64)

    def add(self, h: np.ndarray) -> None:
        for p in self._probes(h):
            np.bitwise_or.at(self.bits, p >> 3, (1 << (p & 7)).astype(np.uint8))

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        left = np.arange(len(h))
        for j in range(4):
            x = h[left]
            p = ((x + (mix(x) | U(1)) * U(j)) & U(FILTER_BITS - 1)).astype(np.int64)
            left = left[(self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1]
        out = np.zeros(len(h), bool)
        out[left] = True
        return out


WINDOWS = "key {}, hash long, place int, slots array<string>"


def _windows(rows: DataFrame, keep: object = None) -> DataFrame:
    """(key, hash, place, slots) per window of (key, text); ``keep`` is a broadcast Filter or None."""
    kind = rows.schema["key"].dataType
    key_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            for start, _, raw, at in chunks(b.column("text")):
                tokens, plains, row, starts, ends = templates(raw, at, words)
                h, first, width = window_hashes(tokens, plains, row)
                found = np.flatnonzero(keep.value.may_hold(h)) if keep is not None else np.arange(len(h))
                if not len(found):
                    continue
                h, first, width = h[found], first[found], width[found]
                of = row[first]
                place = first - np.searchsorted(row, of)  # within the text
                slot = tokens != plains
                value = lambda k: word_class(raw[starts[k] : ends[k]].tobytes().decode())[0] if slot[k] else None
                slots = [[value(k) for k in range(i, i + w)] for i, w in zip(first.tolist(), width.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("key").take(pa.array(of + start)).cast(key_type), pa.array(h.view(np.int64)), pa.array(place, pa.int32()),
                        pa.array(slots, pa.list_(pa.string())),
                    ],
                    ["key", "hash", "place", "slots"],
                )

    return rows.mapInArrow(run, WINDOWS.format(kind.simpleString()))


def _filter_of(windows: DataFrame) -> Filter:
    """The filter of all window hashes, built in the tasks and united bit by bit."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Filter()
        for b in batches:
            f.add(b.column("hash").to_numpy().view(np.uint64))
        blocks = f.bits.view(np.int64)
        used = np.flatnonzero(blocks)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(blocks[used])], ["block", "bits"])

    united = windows.select("hash").mapInArrow(build, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    f = Filter()
    f.bits.view(np.int64)[united.column("block").to_numpy()] = united.column("bits").to_numpy()
    return f


def leaks(named: DataFrame, benchmark: DataFrame, space: Space, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(row, item_id, n_windows, share, exact_slots) per row of a frame of ``common.numbered`` and item that it holds.

    Windows of an item that repeat count once. Along an alignment each slot value of the item stands for the value it
    meets most often, and the other way round (between equals: for itself); windows with another value do not count. So a
    changed slot costs the windows that hold it, not the item.

    Items of one template are one class: texts meet classes, and only texts with enough windows of a class meet its items.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("key"), F.col(text_col).alias("text")).where("key IS NOT NULL")
    known = space.write(_windows(items), "items")
    shape = F.xxhash64(F.array_sort(F.collect_list(F.struct("place", "hash"))))
    classes = space.write(known.groupBy("key").agg(shape.alias("cls"), F.count_distinct("hash").alias("size")), "classes")
    known = space.write(known.join(classes, "key").select(F.col("key").alias("item"), "cls", "size", "hash", F.col("place").alias("item_place"), "slots"), "known")
    keep = named.sparkSession.sparkContext.broadcast(_filter_of(known))  # of fixed size
    mine = _windows(named.select(F.col("row").alias("key"), F.col(f"whole.{text_col}").alias("text")), keep)
    mine = space.write(mine.select(F.col("key").alias("row"), "hash", "place", F.col("slots").alias("got")), "mine")
    shapes = known.select("cls", "size", "hash", "item_place").distinct()
    near = mine.select("row", "hash").distinct().join(shapes.select("cls", "size", "hash").distinct(), "hash").groupBy("row", "cls", "size")
    near = space.write(near.agg(F.count(F.lit(1)).alias("met")).where(F.col("met") >= SHARE * F.col("size")).select("row", "cls"), "near")
    met = mine.join(near, "row").join(shapes, ["cls", "hash"])
    both = met.join(known.select("cls", "item", "item_place", "slots"), ["cls", "item_place"])
    pairs = F.expr("filter(arrays_zip(slots, got), x -> x.slots IS NOT NULL)").alias("pairs")
    aligned = both.select("row", "item", "size", (F.col("place") - F.col("item_place")).alias("offset"), "hash", pairs)
    runs = aligned.groupBy("row", "item", "size", "offset").agg(F.collect_list(F.struct("hash", "pairs")).alias("windows"))  # as many as the item has
    runs = runs.withColumn("pairs", F.flatten(F.transform("windows", lambda w: w["pairs"])))
    distinct = F.transform(
        F.array_distinct("pairs"),
        lambda p: F.struct(p.alias("pair"), F.struct(F.size(F.filter("pairs", lambda q: q == p)), p["slots"] == p["got"], p["got"], p["slots"]).alias("rank")),
    )
    runs = runs.withColumn("ranked", distinct)

    def beaten(p: Column) -> Column:
        other = lambda q: ((q["pair"]["slots"] == p["pair"]["slots"]) | (q["pair"]["got"] == p["pair"]["got"])) & (q["rank"] > p["rank"])
        return F.exists("ranked", other)

    runs = runs.withColumn("odd", F.transform(F.filter("ranked", beaten), lambda p: p["pair"]))
    held = F.filter("windows", lambda w: ~F.arrays_overlap(w["pairs"], F.col("odd")))
    found = (
        runs.select("row", "item", "size", F.explode(held).alias("w"))
        .select("row", "item", "size", "w.hash", F.forall("w.pairs", lambda x: x["slots"] == x["got"]).alias("same"))
        .groupBy("row", "item", "size", "hash").agg(F.max("same").alias("same"))
        .groupBy("row", "item", "size").agg(F.count(F.lit(1)).alias("n_windows"), F.min("same").alias("exact_slots"))
    )
    return found.where(F.col("n_windows") >= SHARE * F.col("size")).select(
        "row", F.col("item").alias("item_id"), "n_windows", (F.col("n_windows") / F.col("size")).alias("share"), "exact_slots"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """doc_id, item_id, n_windows, share, exact_slots per document and benchmark item that it holds.

    Null and empty texts and items hold nothing; items with a null id are not looked for. Repeated rows repeat.
    """
    with Space(docs.sparkSession) as space:
        named = numbered(docs, space)
        hits = space.write(leaks(named, benchmark, space, text_col, item_col), "leaks", keep=True)
    ids = named.select("row", F.col(f"whole.{id_col}").alias("doc_id"))
    return hits.join(ids, "row").select("doc_id", "item_id", "n_windows", "share", "exact_slots")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    with Space(docs.sparkSession) as space:
        named = numbered(docs, space)
        hits = space.write(leaks(named, benchmark, space, text_col, item_col).select("row").distinct(), "leaks", keep=True)
    return named.join(hits, "row", "left_anti").select("whole.*")

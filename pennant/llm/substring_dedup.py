"""Suffix-array dedup: remove every byte covered by a 400-byte string that also starts anywhere else.

A string of 400 bytes is placed by its anchor, the smallest hash among its 64-byte pieces: equal strings have equal
anchors at equal offsets. Consecutive strings of one anchor make a segment. Only segments whose anchor occurs
elsewhere are fetched; equal ones collapse, and what is left of an anchor's segments is sorted as suffixes in two
stages: those smaller than their successor directly, the others by scanning the buckets, and adjacent common
prefixes of 400 bytes or more are repeats. Anchors with very many different segments are settled by hashing
their strings instead, which splits them among all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import Space, numbered
from pennant.llm.words import EXACT, U, chunks, mix, prefix_sums

LENGTH, PIECE = 400, 64
SPAN = LENGTH - PIECE + 1  # pieces of a string
SORT_BYTES = 200_000  # of segments that are sorted at once
GROUP = 250  # different segments of an anchor that are sorted together
BLOCK_BYTES = 2 << 20  # of segments whose strings are hashed together
BUCKET_STRINGS = 400_000  # hashes that meet in one bucket
SEEN = 1 << 18  # texts or segments that a task remembers, to skip copies
FILTER = 1 << 26  # bits of the filter of texts that are fetched: 8 MB


def piece_hashes(raw: np.ndarray) -> np.ndarray:
    sums, inverse = prefix_sums(raw, EXACT)
    n = len(raw) - PIECE + 1
    return mix((sums[PIECE:] - sums[:n]) * inverse[:n])


def segments(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start in its text, strings, anchor hash) of runs of strings with one anchor."""
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    h = piece_hashes(raw)
    key = (h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    n = len(h) - SPAN + 1  # strings
    blocks = -(-len(key) // SPAN)
    padded = np.full(blocks * SPAN, U(0xFFFFFFFFFFFFFFFF))
    padded[: len(key)] = key
    padded = padded.reshape(blocks, SPAN)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(back[:n], ahead[SPAN - 1 : SPAN - 1 + n]) & U(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(n)
    row = np.searchsorted(at, start, side="right") - 1
    inside = start + LENGTH <= at[row + 1]
    place[~inside] = -1
    cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    size = np.diff(np.concatenate([cut, [n]]))
    good = place[cut] >= 0
    cut, size = cut[good], size[good]
    return row[cut], cut - at[row[cut]], size, h[place[cut]]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes' first LENGTH bytes, by two-stage sorting."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1]) + 1
    edges = np.concatenate([[0], change, [n]])
    run_end = np.repeat(edges[1:], np.diff(edges))
    after = np.append(text, 0)[run_end]
    smaller = (run_end < n) & (after > text)  # smaller than its successor
    padded = np.concatenate([text, np.zeros(LENGTH, np.uint8)])
    direct = np.flatnonzero(smaller)
    whole = np.ndarray((n,), f"S{LENGTH}", buffer=padded, strides=(1,))
    direct = direct[np.argsort(whole[direct], kind="stable")]
    counts = np.bincount(text, minlength=256)
    bucket = np.cumsum(counts) - counts
    induced = np.flatnonzero(~smaller)
    n_induced = np.bincount(text[induced], minlength=256)
    rank = np.full(n + 1, -1, np.int64)  # the empty suffix comes first
    first = np.cumsum(np.bincount(text[direct], minlength=256)) - np.bincount(text[direct], minlength=256)
    c = text[direct].astype(np.int64)
    rank[direct] = bucket[c] + n_induced[c] + np.arange(len(direct)) - first[c]
    by_char = induced[np.argsort(text[induced], kind="stable")]
    at = 0
    for c in np.flatnonzero(n_induced):  # buckets in ascending order: what follows a run is already ranked
        own = by_char[at : at + n_induced[c]]
        at += n_induced[c]
        end = run_end[own]
        own = own[np.lexsort((rank[end], end - own))]
        rank[own] = bucket[c] + np.arange(len(own))
    out = np.empty(n, np.int64)
    out[rank[:n]] = np.arange(n)
    return out


def repeated(contents: list[bytes]) -> list[np.ndarray]:
    """For each segment, which of its strings also start elsewhere among the segments."""
    text = np.frombuffer(b"".join(contents), np.uint8)
    real = np.zeros(len(text), bool)
    at = np.cumsum([0] + [len(c) for c in contents])
    for a, c in zip(at, contents):
        real[a : a + len(c) - LENGTH + 1] = True
    order = suffix_array(text)
    order = order[real[order]]
    words = np.ndarray((len(text) - 7,), "<u8", buffer=np.ascontiguousarray(text), strides=(1,))
    alive = np.arange(len(order) - 1)
    for k in range(0, LENGTH, 8):
        alive = alive[words[order[alive] + k] == words[order[alive + 1] + k]]
    found = np.zeros(len(text), bool)
    found[order[alive]] = found[order[alive + 1]] = True
    return [found[a : a + len(c) - LENGTH + 1] for a, c in zip(at, contents)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _key(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


ANCHORS = "row binary, doc_id long, sha binary, n_bytes long, cls binary, anchor long, start int, strings int"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and a row per segment of each text that the task has not seen."""
    seen: set[bytes] = set()
    for b in batches:
        for first, end, raw, at in chunks(b.column("text"), 1 << 20):
            data = raw.tobytes()
            sha = [_key(data[a:z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
            n = len(sha)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("row").slice(first, n), b.column("doc_id").slice(first, n), pa.array(sha, pa.binary()), pa.array(np.diff(at)), pa.nulls(n, pa.binary()),
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
                ],
                ["row", "doc_id", "sha", "n_bytes", "cls", "anchor", "start", "strings"],
            )
            row, start, strings, anchor = segments(raw, at)
            fresh = np.zeros(n, bool)
            for i, s in enumerate(sha):
                fresh[i] = s not in seen
                if len(seen) < SEEN:
                    seen.add(s)
            keep = fresh[row]
            row, start, strings, anchor = row[keep], start[keep], strings[keep], anchor[keep]
            m = len(row)
            cls = pa.DictionaryArray.from_arrays(pa.array(row, pa.int32()), pa.array([s[:16] for s in sha], pa.binary())).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), cls, pa.array(anchor.view(np.int64)),
                    pa.array(start.astype(np.int32)), pa.array(strings.astype(np.int32)),
                ],
                ["row", "doc_id", "sha", "n_bytes", "cls", "anchor", "start", "strings"],
            )


def _place(cls: bytes) -> int:
    return int.from_bytes(cls[:8], "little") % FILTER


def _filter(classes: DataFrame) -> np.ndarray:
    """A bitmap of text classes, built in the tasks; of fixed size."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER // 8, np.uint8)
        for b in batches:
            at = np.asarray([_place(c) for c in b.column("cls").to_pylist()], np.int64)
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        words = bits.view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], ["at", "bits"])

    got = classes.select("cls").mapInArrow(build, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER // 64, np.int64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint8)


def _texts_of(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, body) of the wanted classes, a text at most once per task, joined with the columns of ``classes``."""
    shared = texts.sparkSession.sparkContext.broadcast(_filter(classes))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            for _, _, raw, at in chunks(b.column("text")):
                data = raw.tobytes()
                keys, bodies = [], []
                for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
                    if z - a >= LENGTH:
                        cls = _key(data[a:z])[:16]
                        p = _place(cls)
                        if shared.value[p >> 3] >> (p & 7) & 1 and cls not in seen:
                            if len(seen) < SEEN:
                                seen.add(cls)
                            keys.append(cls)
                            bodies.append(data[a:z])
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(bodies, pa.binary())], ["cls", "body"])

    return texts.mapInArrow(pick, "cls binary, body binary").join(classes, "cls")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, body, parts) to a row per segment; the bytes of a segment are given once per task."""
    seen: set[bytes] = set()
    for b in batches:
        for i in range(b.num_rows):
            cls, body = b.column("cls")[i].as_py(), b.column("body")[i].as_py()
            parts = b.column("parts")[i].as_py()
            content = [body[p["start"] : p["start"] + p["strings"] + LENGTH - 1] for p in parts]
            keys = [hashlib.blake2b(c, digest_size=16).digest() for c in content]
            shown = []
            for k, c in zip(keys, content):
                shown.append(None if k in seen else c)
                if len(seen) < SEEN:
                    seen.add(k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([cls] * len(parts), pa.binary()), pa.array([p["anchor"] for p in parts], pa.int64()), pa.array([p["start"] for p in parts], pa.int32()),
                    pa.array([p["strings"] for p in parts], pa.int32()), pa.array(keys, pa.binary()), pa.array(shown, pa.binary()),
                ],
                ["cls", "anchor", "start", "strings", "content", "bytes"],
            )


SPANS = "content binary, lo int, hi int"


def _sorted_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole anchors, in order, to the runs of repeated strings of each segment."""

    def settle(held: dict[bytes, bytes]) -> pa.RecordBatch:
        out = [(k, a, z) for k, flags in zip(held, repeated(list(held.values()))) for a, z in runs(flags)] if held else []
        columns = list(zip(*out)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int32(), pa.int32()))], ["content", "lo", "hi"])

    held, size, last = {}, 0, None
    for b in batches:
        for anchor, key, data in zip(b.column("anchor").to_pylist(), b.column("content").to_pylist(), b.column("bytes").to_pylist()):
            if anchor != last and size >= SORT_BYTES:
                yield settle(held)
                held, size = {}, 0
            last = anchor
            if key not in held:
                held[key] = data
                size += len(data)
    yield settle(held)


def digests(data: bytes) -> bytes:
    """16 bytes per string of a segment."""
    return b"".join(hashlib.blake2b(data[i : i + LENGTH], digest_size=16).digest() for i in range(len(data) - LENGTH + 1))


def _numbers(hashes: bytes) -> tuple[np.ndarray, int]:
    """Equal hashes get equal numbers; and how many numbers there are."""
    h = np.frombuffer(hashes, np.uint64).reshape(-1, 2)
    order = np.lexsort((h[:, 1], h[:, 0]))
    first = np.ones(len(h), bool)
    first[1:] = (h[order[1:]] != h[order[:-1]]).any(axis=1)
    number = np.empty(len(h), np.int64)
    number[order] = np.cumsum(first) - 1
    return number, int(first.sum())


def _hashed_spans(segments: DataFrame, n_bytes: int, n_strings: int) -> DataFrame:
    """(content, lo, hi): the runs of repeated strings of distinct segments, by hash.

    Segments are dealt to blocks of bounded size. A block gives each bucket its distinct hashes in one row, so a string
    that very many segments hold reaches its bucket once per block. The bucket answers a block with those that repeat,
    and the block marks them on its segments.
    """
    blocks, buckets = -(-n_bytes // BLOCK_BYTES), -(-n_strings // BUCKET_STRINGS)

    def give(table: pa.Table) -> pa.Table:
        hashes = b"".join(digests(c) for c in table.column("bytes").to_pylist())
        number, n = _numbers(hashes)
        one = np.empty((n, 2), np.uint64)
        one[number] = np.frombuffer(hashes, np.uint64).reshape(-1, 2)
        twice = np.bincount(number, minlength=n) > 1
        bucket = (one[:, 0] % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        one, twice, bucket = one[order], twice[order], bucket[order]
        cut = np.concatenate([np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), [n]]).tolist()
        pieces = list(zip(cut[:-1], cut[1:]))
        return pa.table(
            {
                "bucket": bucket[cut[:-1]], "block": pa.array([table.column("block")[0].as_py()] * len(pieces), pa.int64()),
                "hashes": pa.array([one[a:b].tobytes() for a, b in pieces], pa.binary()), "twice": pa.array([twice[a:b].tobytes() for a, b in pieces], pa.binary()),
            }
        )

    def answer(table: pa.Table) -> pa.Table:
        given = table.column("hashes").to_pylist()
        hashes = b"".join(given)
        number, n = _numbers(hashes)
        held = np.bincount(number, minlength=n) + np.bincount(number, np.frombuffer(b"".join(table.column("twice").to_pylist()), bool), n)
        again = held[number] > 1
        h = np.frombuffer(hashes, np.uint64).reshape(-1, 2)
        edge = np.cumsum([0] + [len(g) // 16 for g in given]).tolist()
        found = [h[a:b][again[a:b]].tobytes() for a, b in zip(edge[:-1], edge[1:])]
        return pa.table({"block": table.column("block"), "hashes": pa.array(found, pa.binary())}).filter(pa.array([bool(f) for f in found], pa.bool_()))

    def mark(own: pa.Table, answers: pa.Table) -> pa.Table:
        again = b"".join(answers.column("hashes").to_pylist())
        contents = [digests(c) for c in own.column("bytes").to_pylist()]
        number, n = _numbers(again + b"".join(contents))
        marked = np.zeros(n, bool)
        marked[number[: len(again) // 16]] = True
        flags = marked[number[len(again) // 16 :]]
        edge = np.cumsum([0] + [len(c) // 16 for c in contents]).tolist()
        out = [(k, lo, hi) for k, a, b in zip(own.column("content").to_pylist(), edge[:-1], edge[1:]) for lo, hi in runs(flags[a:b])]
        columns = list(zip(*out)) or [[]] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int32(), pa.int32()))], ["content", "lo", "hi"])

    dealt = segments.withColumn("block", F.pmod(F.xxhash64("content"), F.lit(blocks)).cast("long"))
    given = dealt.groupBy("block").applyInArrow(give, "bucket long, block long, hashes binary, twice binary")
    answers = given.groupBy("bucket").applyInArrow(answer, "block long, hashes binary")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(mark, SPANS)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, body, spans) to the counts and hash of what stays."""
    for b in batches:
        rows = []
        for cls, body, spans in zip(b.column("cls").to_pylist(), b.column("body").to_pylist(), b.column("spans").to_pylist()):
            left = b"".join(body[lo:hi] for lo, hi in kept_gaps(spans, len(body)))
            rows.append((cls, len(body) - len(left), len(merged(spans)), hashlib.sha256(left).digest()))
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.binary()))], ["cls", "n_removed", "n_spans", "kept"])


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal removed runs: spans that overlap or touch are one."""
    out: list[list[int]] = []
    for s in sorted((x["lo"], x["hi"]) for x in spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(x) for x in out]


def kept_gaps(spans: list[dict], n: int) -> list[tuple[int, int]]:
    edges = [0, *(e for s in merged(spans) for e in s), n]
    return [(a, z) for a, z in zip(edges[::2], edges[1::2]) if z > a]


def repeats(named: DataFrame, space: Space, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Of a frame of ``common.numbered``: ((row, doc_id, sha, n_bytes) per document, (cls, spans) per text with repeats); cls is the first half of sha."""
    base = named.select("row", F.col(f"whole.{id_col}").cast("long").alias("doc_id"), F.col(f"whole.{text_col}").alias("text"))
    texts = base.select("text")
    anchors = space.write(base.mapInArrow(_anchors, ANCHORS), "anchors", keep=True)
    found = anchors.where("row IS NULL").select("cls", "anchor", "start", "strings")
    where = F.xxhash64("cls", "start")
    twice = found.groupBy("anchor").agg(F.min(where).alias("lo"), F.max(where).alias("hi")).where("lo <> hi").select("anchor")
    part = F.struct("anchor", "start", "strings")
    parts = found.join(twice, "anchor", "left_semi").groupBy("cls").agg(F.collect_set(part).alias("parts"))  # as long as a text at most
    parts = space.write(parts, "parts")
    cut = space.write(
        _texts_of(texts, parts).mapInArrow(_cut, "cls binary, anchor long, start int, strings int, content binary, bytes binary"), "segments"
    )
    # equal segments collapse; those of several places repeat as a whole
    equal = cut.groupBy("anchor", "content").agg(F.min(where).alias("lo"), F.max(where).alias("hi"), F.first("strings").alias("strings"))
    equal = space.write(equal.select("anchor", "content", "strings", (F.col("lo") != F.col("hi")).alias("several")), "equal")
    sizes = equal.groupBy("anchor").agg(F.count(F.lit(1)).alias("size"), F.sum("strings").alias("strings")).where("size > 1")
    left = cut.where("bytes IS NOT NULL").select("anchor", "content", "bytes").join(sizes, "anchor")
    few = left.where(F.col("size") <= GROUP).select("anchor", "content", "bytes")
    few = few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sorted_spans, SPANS)
    many = space.write(left.where(F.col("size") > GROUP).dropDuplicates(["content"]).select("content", "bytes"), "many")
    size, strings = sizes.where(F.col("size") > GROUP).agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("strings"), F.lit(0))).first()
    many = _hashed_spans(many, max(1, strings + size * (LENGTH - 1)), max(1, strings))
    whole = equal.where("several").select("content", F.lit(0).alias("lo"), F.col("strings").alias("hi"))
    spans = space.write(
        whole.union(few).union(many).groupBy("content").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans"
    )
    covered = (
        cut.select("cls", "start", "content").join(spans, "content")
        .select("cls", F.explode(F.transform("spans", lambda s: F.struct(
            (F.col("start") + s["lo"]).alias("lo"), (F.col("start") + s["hi"] + (LENGTH - 1)).alias("hi")))).alias("span"))
        .groupBy("cls").agg(F.collect_set("span").alias("spans"))
    )
    return anchors.where("row IS NOT NULL").select("row", "doc_id", "sha", "n_bytes"), space.write(covered, "covered", keep=True)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed, removed_share per row of ``docs``; null is an empty text.

    Texts under 400 bytes lose nothing. Rows with equal texts of 400 bytes or more lose all of it, whatever their ids.
    """
    with Space(docs.sparkSession) as space:
        named = numbered(docs, space)
        rows, covered = repeats(named, space, id_col, text_col)
        texts = named.select(F.col(f"whole.{text_col}").alias("text"))
        left = space.write(_texts_of(texts, covered).mapInArrow(_remove, "cls binary, n_removed long, n_spans long, kept binary").dropDuplicates(["cls"]), "left", keep=True)
    copies = rows.where(F.col("n_bytes") >= LENGTH).groupBy("sha").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    changed = (
        copies.select("sha", F.substring("sha", 1, 16).alias("cls"))
        .select("cls", F.lit(True).alias("gone"))
        .join(left, "cls", "full")
    )
    nothing = F.unhex(F.sha2(F.lit(b""), 256))
    out = (
        rows.withColumn("cls", F.substring("sha", 1, 16)).join(changed, "cls", "left")
        .select(
            "doc_id", "n_bytes", F.when(F.col("gone"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(F.col("gone"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.lower(F.hex(F.when(F.col("gone"), nothing).otherwise(F.coalesce("kept", "sha")))).alias("kept_sha256"),
        )
    )
    share = F.when(F.col("n_bytes") > 0, F.col("n_removed") / F.col("n_bytes")).otherwise(0.0)
    return out.withColumns({"removed": F.col("n_removed") > 0, "removed_share": share})

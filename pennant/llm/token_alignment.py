"""Cross-tokenizer alignment: groups of tokens of two tokenizers that end at the same bytes, and counts of linked ids.

The tokens of a text's byte range are a fragment: an open prefix up to the first byte at which both tokenizers end a
token, closed groups, and an open suffix. Fragments compose associatively: the left one's suffix and the right one's
prefix are one group. A short text is one fragment in which everything is closed. A long text is cut into byte ranges that
are dealt to tasks on their own, and a tree of groupings composes their open ends; closed groups stay where they are.

A range is tokenized together with its surroundings up to the next points where neither tokenizer looks across: a space
between two visible ASCII characters starts a word in both. A text without such points is one range.

Counts. Texts are packed into blocks of some BLOCK bytes, each with its distinct id pairs. Only those pairs are added up
over the corpus, and only those meet the sums again, so that a frequent pair is one row per block however often it is
linked, and no table of pairs is sent to every task.

Memory. A block of short texts is several rows: each holds the texts of one STEP and a slice of the block's pairs. Tables
with such rows are written in small row groups, since a scan holds a row group's rows at once. So what a task holds
depends neither on the corpus nor on how many blocks a file of it gives.

Texts that are null or empty, or that a tokenizer does not give back byte by byte, have no tokens: zeros and ''. Equal
rows and equal or null ids are texts like others. An empty table has no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import Space, shared_folder
from pennant.llm.words import texts

RANGE = 1 << 16
BLOCK = 4 << 20
STEP = 1 << 18  # bytes that are aligned at a time
SLICE = 1 << 15  # pairs of a block in one row
GROUP = 8 << 20  # bytes of a row group
TREE = 3  # log2 of the fragments that one composition takes
MARK = "▁"
# Fixed value: how byte-level models of this kind divide text before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PART = "n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>"
BLOCK_SCHEMA = f"block binary, key binary, ids array<bigint>, {PART}, sha array<string>, base bigint, pairs array<bigint>, times array<bigint>, links binary"
OPEN = "a array<bigint>, a_end array<bigint>, b array<bigint>, b_end array<bigint>"
FRAGMENT_SCHEMA = f"key binary, k bigint, valid boolean, has boolean, head struct<{OPEN}>, tail struct<{OPEN}>, body binary, {BLOCK_SCHEMA.replace('key binary, ', '')}"
RANGE_SCHEMA = "key binary, doc_id bigint, k bigint, lo bigint, hi bigint, start bigint, text binary"
RESULT = "key binary, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def visible_bytes() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """The byte-level model of a tokenizer file. Ids are merge ranks, which is checked, so that a rank-based encoder
    gives the same ids; the file's own library takes over where that encoder gives up."""

    def __init__(self, file: bytes) -> None:
        import tiktoken

        model = json.loads(file)["model"]
        vocab, of = model["vocab"], visible_bytes()
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        if made != sorted(made) or len(made) + 256 != len(vocab):
            raise ValueError("ids of the byte-level model do not follow its merges")
        self.pieces = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.pieces[i] = bytes(of[c] for c in token)
        self.file, self.slow = file, None
        self.fast = tiktoken.Encoding("byte-level", pat_str=WORDS, mergeable_ranks={self.pieces[i]: i for i in vocab.values()}, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except ValueError:  # its expression engine gives up on some millions of spaces in a row
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_str(self.file.decode())
                self.slow.encode_special_tokens = True
            return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """A SentencePiece model that adds the space before a text itself."""

    def __init__(self, file: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=file)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        if any(MARK in p.lstrip(MARK) for p in names):
            raise ValueError("pieces of the model go across words")
        self.pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Both models, and tables from their ids to bytes and to printed ids."""

    def __init__(self, a: bytes, b: bytes) -> None:
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.a_len = np.asarray([len(p) for p in self.a.pieces], np.int64)
        self.b_len = np.asarray([len(p) for p in self.b.pieces], np.int64)
        n, m = len(self.a_len), len(self.b_len)
        self.width = m
        # printed ids: of A before another A, of A before B, of B before another B, of B at a group's end
        table = [b"%d%s" % (i, s) for k, s in ((n, b","), (n, b"|"), (m, b","), (m, b";")) for i in range(k)]
        self.printed = np.asarray(table, object)
        self.base = (0, n, 2 * n, 2 * n + m)

    def tokens(self, many: list[bytes]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both models per text, which starts with a space; None where the bytes differ."""
        plain = [t.decode() for t in many]
        out = []
        for raw, text, b in zip(many, plain, self.b.encode_all([t[1:] for t in plain])):
            a = self.a.encode(text)
            same = b"".join(map(self.b.pieces.__getitem__, b)) == raw and b"".join(map(self.a.pieces.__getitem__, a.tolist())) == raw
            out.append((a, np.asarray(b, np.int64)) if same else None)
        return out

    def groups(self, a, a_end, b, b_end):
        """Of closed groups, which start at 0: (ends of groups, ends of links, pair per link, printed tokens, place of
        each group's last token among them)."""
        size = int(a_end[-1]) + 1 if len(a_end) else 1
        ends_a, ends_b = np.zeros(size, bool), np.zeros(size, bool)
        ends_a[a_end], ends_b[b_end] = True, True
        common, links = np.flatnonzero(ends_a & ends_b), np.flatnonzero(ends_a | ends_b)
        pair = a[np.searchsorted(a_end, links)] * self.width + b[np.searchsorted(b_end, links)]
        upto_a, upto_b = np.searchsorted(a_end, common, side="right"), np.searchsorted(b_end, common, side="right")
        of_a, of_b = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.concatenate(([0], upto_b))[of_a]] = a + np.where(ends_b[a_end], self.base[1], self.base[0])
        codes[np.arange(len(b)) + upto_a[of_b]] = b + np.where(ends_a[b_end], self.base[3], self.base[2])
        return common, links, pair, self.printed[codes], upto_a + upto_b


_MODELS: dict[str, Aligner] = {}


def _aligner(shared) -> Aligner:
    """One per Python worker and pair of models."""
    a, b = shared.value
    name = hashlib.sha256(a + b).hexdigest()
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = Aligner(a, b)
    return _MODELS[name]


class Packer:
    """Collects parts until a block is full."""

    def __init__(self, key: bytes | None = None) -> None:
        self.key, self.rows, self.pairs, self.bytes = key, [], [], 0

    def add(self, ids: list, n_a, n_b, n_groups, n_links, sha: list, pair: np.ndarray, size: int) -> None:
        self.rows.append({"ids": ids, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "sha": sha})
        pairs, index, times = np.unique(pair, return_inverse=True, return_counts=True)
        self.pairs.append((pairs, index.astype(_places(len(pairs))), times))
        self.bytes += size

    def block(self, size: int = SLICE) -> Iterator[dict]:
        """The block's rows, one per part at least; it is empty afterwards. ``links`` are places among all pairs, of two
        bytes each if that does; ``base`` is the place of the row's own first pair."""
        rows, parts = self.rows, self.pairs
        self.rows, self.pairs, self.bytes = [], [], 0
        name, none = os.urandom(16), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate([none, *(p for p, _, _ in parts)]))
        places, times = [np.searchsorted(pairs, p) for p, _, _ in parts], np.zeros(len(pairs), np.int64)
        for at, (_, _, n) in zip(places, parts):
            times[at] += n
        empty = {"ids": [], "n_a": [], "n_b": [], "n_groups": [], "n_links": [], "sha": []}
        for i in range(max(len(rows), -(-len(pairs) // size))):
            links = places[i].astype(_places(len(pairs)))[parts[i][1]].tobytes() if i < len(rows) else b""
            low = min(i * size, len(pairs))
            own = {"base": low, "pairs": pairs[low : low + size], "times": times[low : low + size], "links": links}
            yield {"block": name, "key": self.key} | (rows[i] if i < len(rows) else empty) | own


def _places(n: int) -> str:
    """The type of places among n values."""
    return "<u2" if n <= 1 << 16 else "<u4"


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def _align_step(model: Aligner, ids: list, many: list[bytes | None], packer: Packer) -> None:
    """Whole short texts, one after the other on one line of bytes."""
    found = iter(model.tokens([b" " + t for t in many if t]))
    coded = [next(found) if t else None for t in many]
    kept = [c for c in coded if c is not None]
    if kept:
        a, b = (np.concatenate([c[i] for c in kept]) for i in (0, 1))
        sizes = np.cumsum([len(t) + 1 for t, c in zip(many, coded) if c is not None])
        common, links, pair, printed, place = model.groups(a, np.cumsum(model.a_len[a]), b, np.cumsum(model.b_len[b]))
        last = np.searchsorted(common, sizes)  # the group that ends each text
        n_groups, n_links = np.diff(last + 1, prepend=0), np.diff(np.searchsorted(links, sizes) + 1, prepend=0)
        stops = [0, *place[last].tolist()]
        strings = printed.tolist()
    else:
        pair = np.zeros(0, np.int64)
    out, k = [], 0
    for c in coded:
        if c is None:
            out.append((0, 0, 0, 0, ""))
            continue
        text = b"".join(strings[stops[k] : stops[k + 1]])[:-1]
        out.append((len(c[0]), len(c[1]), int(n_groups[k]), int(n_links[k]), hashlib.sha256(text).hexdigest()))
        k += 1
    packer.add(ids, *([r[i] for r in out] for i in range(5)), pair, sum(len(t or b"") for t in many))


def _short(shared, schema: pa.Schema) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, packer = _aligner(shared), Packer()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            raw, at = texts(batch.column("text"))
            row = 0
            while row < len(ids):
                end = max(row + 1, int(np.searchsorted(at, at[row] + STEP, side="right")) - 1)
                many = [raw[at[i] : at[i + 1]].tobytes() for i in range(row, end)]
                _align_step(model, ids[row:end], many, packer)
                row = end
                if packer.bytes >= BLOCK:
                    yield from (_batch([r], schema) for r in packer.block())
        yield from (_batch([r], schema) for r in packer.block())

    return run


def ranges(text: bytes, size: int = RANGE) -> Iterator[tuple[int, int, int, int]]:
    """(low, high, start, end): byte ranges of space and text, and the safe points around each."""
    raw = np.frombuffer(text, np.uint8)
    seen = (raw >= 0x21) & (raw <= 0x7E)
    safe = np.flatnonzero(seen[:-2] & (raw[1:-1] == 0x20) & seen[2:]) + 1
    cuts = np.concatenate(([0], safe, [len(raw)]))
    low = 0
    while low < len(raw):
        high = min(low + size, len(raw))
        start = cuts[np.searchsorted(cuts, low, side="right") - 1]
        end = cuts[np.searchsorted(cuts, high)]
        if end - start > 4 * size:  # no safe point near: such a stretch is not split
            high = end
        yield low, int(high), int(start), int(end)
        low = int(high)


def _cut(schema: pa.Schema) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text, key = batch.column("doc_id")[i].as_py(), b" " + batch.column("text")[i].as_py().encode(), os.urandom(16)
                for k, (low, high, start, end) in enumerate(ranges(text)):
                    row = {"key": key, "doc_id": doc, "k": k, "lo": low, "hi": high, "start": start, "text": text[start:end]}
                    yield _batch([row], schema)

    return run


def _open(a, a_end, b, b_end) -> dict:
    return {"a": a, "a_end": a_end, "b": b, "b_end": b_end}


def fragment(model: Aligner, row: dict) -> dict:
    """The fragment of a byte range: the tokens that end in it."""
    key, doc = row["key"], row["doc_id"]
    coded = model.tokens([row["text"]])[0]
    packer, none = Packer(key), np.zeros(0, np.int64)
    valid = coded is not None
    a, b = coded if valid else (none, none)
    a_end, b_end = row["start"] + np.cumsum(model.a_len[a]), row["start"] + np.cumsum(model.b_len[b])
    mine_a, mine_b = (a_end > row["lo"]) & (a_end <= row["hi"]), (b_end > row["lo"]) & (b_end <= row["hi"])
    a, a_end, b, b_end = a[mine_a], a_end[mine_a], b[mine_b], b_end[mine_b]
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    has = len(common) > 0
    first, last = (common[0], common[-1]) if has else (row["hi"], row["hi"])

    def between(low, high):
        x, y = (a_end > low) & (a_end <= high), (b_end > low) & (b_end <= high)
        return a[x], a_end[x], b[y], b_end[y]

    body = closed(model, packer, doc, between(first, last), int(first))
    out = {"key": key, "k": row["k"], "valid": valid, "has": has, "head": _open(*between(row["lo"], first)), "tail": _open(*between(last, row["hi"])), "body": body}
    return _whole(packer) | out


def _whole(packer: Packer) -> dict:
    """The row of a block of one part."""
    (row,) = packer.block(max(SLICE, len(packer.pairs[0][0])))
    return row


def closed(model: Aligner, packer: Packer, doc: int | None, tokens: tuple, at: int) -> bytes:
    """Pack closed groups that start at byte ``at``; their printed form."""
    a, a_end, b, b_end = (np.asarray(x, np.int64) for x in tokens)
    common, links, pair, printed, _ = model.groups(a, a_end - at, b, b_end - at)
    packer.add([doc], [len(a)], [len(b)], [len(common)], [len(links)], [None], pair, 0)
    return b"".join(printed.tolist())[:-1]


def _fragments(shared, schema: pa.Schema) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _aligner(shared)
        for batch in batches:
            for i in range(batch.num_rows):
                yield _batch([fragment(model, batch.slice(i, 1).to_pylist()[0])], schema)

    return run


def compose(left: dict, right: dict) -> tuple[dict, tuple[int, dict] | None]:
    """Two neighbours as one, and the group that closes between them, if any, with the range in which it ends."""
    def put(x: dict, y: dict) -> dict:
        return {c: [*x[c], *y[c]] for c in ("a", "a_end", "b", "b_end")}

    if not right["has"]:  # then all of it is its head
        where = "tail" if left["has"] else "head"
        return left | {where: put(left[where], right["head"])}, None
    if not left["has"]:
        return right | {"head": put(left["head"], right["head"])}, None
    return left | {"tail": right["tail"]}, (right["first"], put(left["tail"], right["head"]))


def _compose_all(schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        parts = sorted(rows.to_pylist(), key=lambda r: r["k"])
        out, whole = [], parts[0]
        for part in parts[1:]:
            whole, bridge = compose(whole, part)
            if bridge is not None:
                out.append(whole | {"k": bridge[0], "bridge": True, "head": bridge[1], "tail": None})
        out.append(whole | {"k": parts[0]["k"] >> TREE, "bridge": False})
        return pa.Table.from_batches([_batch(out, schema)])

    return run


def _bridges(shared, schema: pa.Schema) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Groups that close between ranges, as fragments without open ends."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _aligner(shared)
        for batch in batches:
            for row in batch.to_pylist():
                x, packer = row["head"], Packer(row["key"])
                at = x["a_end"][0] - int(model.a_len[x["a"][0]])  # where the group before ended
                body = closed(model, packer, None, (x["a"], x["a_end"], x["b"], x["b_end"]), at)
                yield _batch([_whole(packer) | {"key": row["key"], "k": row["k"], "valid": True, "has": True, "head": None, "tail": None, "body": body}], schema)

    return run


def _hashes(schema: pa.Schema) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come in the order of text and place; one digest is open at a time."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, some = None, None, False
        for batch in batches:
            done = []
            for k, body in ((k, b.as_py()) for k, b in zip(batch.column("key").to_pylist(), batch.column("body"))):
                if k != key:
                    if key is not None:
                        done.append({"key": key, "sha": digest.hexdigest()})
                    key, digest, some = k, hashlib.sha256(), False
                if body:
                    digest.update(b";" + body if some else body)
                    some = True
            if done:
                yield _batch(done, schema)
        if key is not None:
            yield _batch([{"key": key, "sha": digest.hexdigest()}], schema)

    return run


def _score(schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block's parts with the sums of its links' counts."""
    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("pos").to_numpy())
        total, best = found.column("total").to_numpy()[order], found.column("best").to_numpy()[order]
        kind, out = _places(len(total)), []
        for i in range(block.num_rows):
            row = block.slice(i, 1).to_pylist()[0]
            links = np.frombuffer(row["links"], kind)
            starts = np.concatenate(([0], np.cumsum(np.asarray(row["n_links"], np.int64))))
            sums, hits = (np.concatenate(([0], np.cumsum(x[links] if len(links) else links, dtype=np.int64))) for x in (total, best))
            n = len(row["ids"])
            columns = {
                "key": [row["key"]] * n, "doc_id": row["ids"], "n_a": row["n_a"], "n_b": row["n_b"], "n_groups": row["n_groups"], "n_links": row["n_links"],
                "n_best": np.diff(hits[starts]), "count_sum": np.diff(sums[starts]), "groups_sha256": row["sha"],
            }
            out.append(pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema))
        return pa.Table.from_batches(out, schema)

    return run


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def long_texts(docs: DataFrame, shared, space: Space) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of (doc_id, text): blocks, (key, sha) per text that has tokens, and (key, doc_id) of all texts."""
    spark = docs.sparkSession
    arrow = {s: _arrow(spark, s) for s in (RANGE_SCHEMA, FRAGMENT_SCHEMA)}
    cut = space.write(docs.mapInArrow(_cut(arrow[RANGE_SCHEMA]), RANGE_SCHEMA), "ranges", group=GROUP)
    names = space.write(cut.where("k = 0").select("key", "doc_id"), "keys", keep=True)
    parts = space.write(cut.repartition("key", "k").mapInArrow(_fragments(shared, arrow[FRAGMENT_SCHEMA]), FRAGMENT_SCHEMA), "fragments", keep=True, group=GROUP)
    bad = parts.where("NOT valid").select("key").distinct()
    parts = parts.join(bad, "key", "left_anti")
    tree = f"key binary, k bigint, first bigint, has boolean, bridge boolean, head struct<{OPEN}>, tail struct<{OPEN}>"
    here = space.write(parts.select("key", "k", F.col("k").alias("first"), "has", F.lit(False).alias("bridge"), "head", "tail"), "tree")
    most = here.agg(F.max("k")).first()[0] or 0
    found = []
    while most > 0:
        up = here.where("NOT bridge").groupBy("key", F.shiftright("k", TREE).alias("up")).applyInArrow(_compose_all(_arrow(spark, tree)), tree)
        here = space.write(up, "tree")
        found.append(here.where("bridge"))
        most >>= TREE
    # what is left of a text is one fragment, whose head is its first group
    groups = here.where("NOT bridge").withColumn("k", F.col("first"))
    for more in found:
        groups = groups.unionByName(more)
    groups = groups.select("key", "k", "head").where(F.size("head.a") > 0)
    ends = space.write(groups.mapInArrow(_bridges(shared, arrow[FRAGMENT_SCHEMA]), FRAGMENT_SCHEMA), "bridges", keep=True, group=GROUP)
    bodies = ends.select("key", "k", F.lit(0).alias("side"), "body").unionByName(parts.select("key", "k", F.lit(1).alias("side"), "body"))
    sha_schema = "key binary, sha string"
    shas = bodies.repartition("key").sortWithinPartitions("key", "k", "side").mapInArrow(_hashes(_arrow(spark, sha_schema)), sha_schema)
    columns = [f.name for f in _arrow(spark, BLOCK_SCHEMA)]
    return ends.select(columns).unionByName(parts.select(columns)), space.write(shas, "shas", keep=True), names


def align(docs: DataFrame, a: bytes, b: bytes, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 per document.

    ``a`` is a byte-level model's file, ``b`` that of a SentencePiece model; both are of bounded size and are sent to
    every executor once. Texts of more than ``range_bytes`` bytes are split.
    """
    spark = docs.sparkSession
    shared_folder(spark)
    shared = spark.sparkContext.broadcast((a, b))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.octet_length("text") > range_bytes, F.lit(False))
    with Space(spark) as space:
        small = base.where(~is_long).mapInArrow(_short(shared, _arrow(spark, BLOCK_SCHEMA)), BLOCK_SCHEMA)
        small = space.write(small, "blocks", group=GROUP)
        large, shas, names = long_texts(base.where(is_long), shared, space)
        blocks = small.unionByName(space.write(large, "long", group=GROUP))
        counts = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("total"))
        counts = space.write(counts.withColumn("b", F.col("pair") % _width(b)), "counts")
        most = counts.groupBy("b").agg(F.max("total").alias("most"))
        judged = counts.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))
        asked = blocks.select("block", "base", F.posexplode("pairs").alias("pos", "pair"))
        answers = asked.join(judged, "pair").select(F.col("block").alias("of"), (F.col("base") + F.col("pos")).alias("pos"), "total", "best")
        scored = blocks.drop("base", "pairs", "times").groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_score(_arrow(spark, RESULT)), RESULT)
        scored = space.write(scored, "scored", keep=True)
    names_of = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    short = scored.where("key IS NULL").select("doc_id", *names_of, "groups_sha256")
    sums = scored.where("key IS NOT NULL").groupBy("key").agg(*[F.sum(c).alias(c) for c in names_of]).join(shas, "key")
    long = names.join(sums, "key", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in names_of], F.coalesce("sha", F.lit("")).alias("groups_sha256")
    )
    return short.unionByName(long)


def _width(b: bytes) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=b).get_piece_size()

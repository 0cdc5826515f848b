"""Exact dedup by Patricia-trie owners.

Texts are compared without their white space. Every map task first puts its texts into a compressed radix trie,
so that copies within a task become one terminal; rows then move by length and content hash, and each partition
inserts the full byte strings again. A terminal keeps its best owner, the number of rows and the number that tie
with the owner. A trie over its byte budget hands its largest subtree on, as partial owners, and goes on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import SPACES, Space, numbered

TRIE_BYTES = 48 << 20
NODE_COST = 200
Owner = tuple  # (-code points, id is null, id, row, rows with this text)


class Node:
    __slots__ = ("label", "below", "owner")

    def __init__(self, label: bytes, owner: Owner | None = None) -> None:
        self.label, self.below, self.owner = label, {}, owner


def _better(a: Owner | None, b: Owner) -> Owner:
    if a is None:
        return b
    return (*min(a[:4], b[:4]), a[4] + b[4])


class Trie:
    """Compressed radix trie of byte strings; a node's label is the path from its parent."""

    def __init__(self) -> None:
        self.root, self.cost = Node(b""), 0

    def insert(self, key: bytes, owner: Owner) -> None:
        node, at, n = self.root, 0, len(key)
        while at < n:
            child = node.below.get(key[at])
            if child is None:
                node.below[key[at]] = Node(key[at:], owner)
                self.cost += n - at + NODE_COST
                return
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            low, high = 1, min(len(label), n - at)  # first byte agrees; bisect the common prefix
            while low < high:
                mid = (low + high + 1) // 2
                if label[:mid] == key[at : at + mid]:
                    low = mid
                else:
                    high = mid - 1
            fork = Node(label[:low])
            child.label = label[low:]
            fork.below[child.label[0]] = child
            node.below[key[at]] = fork
            self.cost += NODE_COST
            node, at = fork, at + low
        node.owner = _better(node.owner, owner)

    def terminals(self, first: int | None = None) -> Iterator[tuple[bytes, Owner]]:
        """(string, owner) of the whole trie, or of the subtree under one first byte."""
        if first is None and self.root.owner is not None:
            yield b"", self.root.owner
        stack = [(b"", n) for c, n in self.root.below.items() if first in (None, c)]
        while stack:
            path, node = stack.pop()
            path += node.label
            if node.owner is not None:
                yield path, node.owner
            stack += [(path, n) for n in node.below.values()]

    def spill(self) -> list[tuple[bytes, Owner]]:
        """Hand over and cut off the largest subtree under the root."""
        sizes = {c: sum(len(k) + NODE_COST for k, _ in self.terminals(c)) for c in self.root.below}
        first = max(sizes, key=sizes.get)
        out = list(self.terminals(first))
        del self.root.below[first]
        self.cost = max(0, self.cost - sizes[first])
        return out


def _hash(key: bytes) -> int:
    return int.from_bytes(hashlib.sha256(key).digest()[:8], "little", signed=True)


PARTIAL = "length long, content long, body binary, neg_points long, no_id boolean, id long, row binary, rows long"


def _batch(found: list[tuple[bytes, Owner]]) -> pa.RecordBatch:
    keys = [k for k, _ in found]
    columns = [[o[i] for _, o in found] for i in range(5)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([len(k) for k in keys], pa.int64()), pa.array([_hash(k) for k in keys], pa.int64()), pa.array(keys, pa.binary()),
            pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.int64()),
            pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.int64()),
        ],
        ["length", "content", "body", "neg_points", "no_id", "id", "row", "rows"],
    )


def _slices(found: list[tuple[bytes, Owner]], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for x in found:
        part.append(x)
        size += len(x[0]) + 100
        if size >= most:
            yield _batch(part)
            part, size = [], 0
    if part:
        yield _batch(part)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map side: (row, id, points, body) to partial owners."""
    trie = Trie()
    for b in batches:
        for row, doc, points, body in zip(*(b.column(n).to_pylist() for n in ("row", "id", "points", "body"))):
            trie.insert(body, (-points, doc is None, doc or 0, row, 1))
            if trie.cost > TRIE_BYTES:
                yield from _slices(trie.spill())
    yield from _slices(list(trie.terminals()))


OWNERS = "sha binary, keep_id long, keep_row binary, rows long"


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: rows sorted by (length, content) run by run; equal texts are always in one run."""
    trie, run = Trie(), None

    def done(trie: Trie) -> list[tuple]:
        return [(hashlib.sha256(k).digest(), None if o[1] else o[2], o[3], o[4]) for k, o in trie.terminals()]

    for b in batches:
        out = []
        for length, content, body, neg, no_id, doc, row, rows in zip(*(c.to_pylist() for c in b.columns)):
            if run != (length, content):
                out += done(trie)
                trie, run = Trie(), (length, content)
            trie.insert(body, (neg, no_id, doc, row, rows))
        yield _owner_batch(out)
    yield _owner_batch(done(trie))


def _owner_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int64()]
    columns = list(zip(*out)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["sha", "keep_id", "keep_row", "rows"])


def owners(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, sha, keep_id, keep_row, rows) per row of a frame of ``common.numbered``."""
    body = F.translate(F.coalesce(F.col(f"whole.{text_col}"), F.lit("")), SPACES, "")
    base = rows.select(
        "row", F.col(f"whole.{id_col}").cast("long").alias("id"),
        F.coalesce(F.length(f"whole.{text_col}"), F.lit(0)).cast("long").alias("points"),
        F.encode(body, "UTF-8").alias("body"),
    )
    partial = base.mapInArrow(_combine, PARTIAL)
    owned = partial.repartition("length", "content").sortWithinPartitions("length", "content").mapInArrow(_owners, OWNERS)
    light = base.select("row", "id", F.unhex(F.sha2("body", 256)).alias("sha"))
    return light.join(owned, "sha").select("row", F.col("id").alias("doc_id"), "sha", "keep_id", "keep_row", "rows")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts, and texts of white space alone, are equal to each other. Of equal texts the one with
    most code points stays, then the smallest id; a null id comes after every other. Of rows that repeat an id and
    a text exactly one is kept. An empty table gives an empty result; other columns are not looked at.
    """
    with Space(docs.sparkSession) as space:
        found = owners(numbered(docs, space), id_col, text_col)
    return found.select(
        "doc_id", "keep_id", F.col("rows").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``: one of each set of equal texts (see ``exact_groups``), so also
    one of all rows without a text, and one of rows that are equal in everything."""
    with Space(docs.sparkSession) as space:
        rows = numbered(docs, space)
        dropped = owners(rows, id_col, text_col).where("row <> keep_row").select("row")
    return rows.join(dropped, "row", "left_anti").select("whole.*")

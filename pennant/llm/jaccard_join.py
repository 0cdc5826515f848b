"""N-gram Jaccard join over a token-group matrix.

Texts are sets of word shingles, equal sets one node. Shingles have one global order, rare ones first (by a counting
sketch, then by hash). Linked sets share some of their first shingles in that order, so only those enter the
matrix, and of those only shingles that several nodes hold.

Similar nodes are partitioned into groups: nodes with the same smallest hash are checked against their group's
leader, and what links up is a group (large ones are split). The matrix holds each group's union of first shingles.
Where a node meets a union, the places of the shingle bound its overlap with every member; only groups that reach
the bound are opened, and only groups it is not yet linked with. Opened pairs are checked on their whole sets, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import Space, components, numbered
from pennant.llm.words import U, chunks, mix, shingle_sets

NUMERATOR, DENOMINATOR = 75, 100  # linked: 100 * intersection >= 75 * union
SHARED = 2  # first shingles that linked sets must share; unlike texts that share one by chance are many in a large corpus
SKETCH = 1 << 20  # counters; 4 MB are sent to every task
SKETCH_BLOCK = 1 << 14
GROUP = 64  # nodes of a group at most, but for unevenly dealt ones
BAND = 1.1  # sizes of a group differ by this factor at most
LOWS = ("low_a", "low_b", "low_c")
NODE_FILTER = 1 << 26  # bits of the filter of candidate nodes: 8 MB
SEEN = 1 << 18  # nodes that a task remembers, to skip copies
BUCKET_TOKENS = 400_000

_A, _B, _C, _D = (U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _need(n: np.ndarray | int) -> np.ndarray | int:
    """The least intersection of a set of n with a linked set."""
    return -(-NUMERATOR * n // DENOMINATOR)


def _node(s: np.ndarray) -> int:
    return int(mix(s + _A).sum(dtype=np.uint64)) if len(s) else 0


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


PROFILE = "row binary, id long, n long, node long, check long, low_a long, low_b long, low_c long, block int, counts binary, part int"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with its set's size, fingerprints and smallest hashes; at the end the task's sketch."""
    sketch, seen, part = np.zeros(SKETCH, np.uint32), set(), 0

    def batch(columns: list, sketch_rows: bool) -> pa.RecordBatch:
        n = len(columns[0])
        empty = [pa.nulls(n, t) for t in (pa.binary(), *(pa.int64(),) * 7)] if sketch_rows else [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32())]
        arrays = [*empty, *columns] if sketch_rows else [*columns, *empty]
        return pa.RecordBatch.from_arrays(arrays, ["row", "id", "n", "node", "check", "low_a", "low_b", "low_c", "block", "counts", "part"])

    for b in batches:
        part = b.column("part")[0].as_py() if b.num_rows else part
        for start, end, raw, at in chunks(b.column("text")):
            sets = shingle_sets(raw, at)
            out = np.zeros((6, len(sets)), np.uint64)
            for i, s in enumerate(sets):
                if len(s):
                    out[:, i] = len(s), _node(s), mix(s ^ _B).sum(dtype=np.uint64), mix(s + _C).min(), mix(s ^ _C).min(), mix(s ^ _D).min()
            fresh = []
            for i, node in enumerate(out[1].tolist()):
                if node not in seen:
                    fresh.append(sets[i])
                    if len(seen) < SEEN:
                        seen.add(node)
            if fresh:
                sketch += np.bincount((np.concatenate(fresh) % U(SKETCH)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
            known = [b.column("row").slice(start, end - start), b.column("id").slice(start, end - start)]
            yield batch(known + [pa.array(c.view(np.int64)) for c in out], False)
    used = [i for i in range(SKETCH // SKETCH_BLOCK) if sketch[i * SKETCH_BLOCK : (i + 1) * SKETCH_BLOCK].any()]
    blobs = [sketch[i * SKETCH_BLOCK : (i + 1) * SKETCH_BLOCK].tobytes() for i in used]
    if used:
        yield batch([pa.array(used, pa.int32()), pa.array(blobs, pa.binary()), pa.array([part] * len(used), pa.int32())], True)


def _sketch(profile: DataFrame) -> np.ndarray:
    """The sum of the tasks' sketches, in a tree of bounded fan-in."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH_BLOCK, np.uint32)
        for blob in table.column("counts"):
            total = np.minimum(total.astype(np.uint64) + np.frombuffer(blob.as_buffer(), np.uint32), 0xFFFFFFFF).astype(np.uint32)
        return pa.table({"block": table.column("block")[:1], "counts": pa.array([total.tobytes()], pa.binary()), "part": table.column("part")[:1]})

    rows = profile.where("block IS NOT NULL").select("block", "counts", "part")
    for width in (4096, 64, 1):
        rows = rows.withColumn("part", F.pmod("part", F.lit(width)).cast("int")).groupBy("block", "part").applyInArrow(add, rows.schema)
    out = np.zeros(SKETCH, np.uint32)
    for r in rows.select("block", "counts").collect():  # of fixed size
        out[r.block * SKETCH_BLOCK : (r.block + 1) * SKETCH_BLOCK] = np.frombuffer(r.counts, np.uint32)
    return out


def _first(s: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """In order, the shingles of a set that any linked set must share SHARED of (or all it must share, if fewer)."""
    need = _need(len(s))
    order = np.lexsort((s, sketch[(s % U(SKETCH)).astype(np.int64)]))
    return s[order[: len(s) - need + min(SHARED, need)]]


def _new_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(node, set) of each text of a task whose set was not seen in it before."""
    seen: set[int] = set()
    for b in batches:
        for _, _, raw, at in chunks(b.column("text")):
            for s in shingle_sets(raw, at):
                node = _node(s)
                if len(s) and node not in seen:
                    if len(seen) < SEEN:
                        seen.add(node)
                    yield node, s


def _shared_tokens(texts: DataFrame, sketch: np.ndarray, shingles: int) -> DataFrame:
    """(token, node, place): first shingles that several nodes hold, with their place in the node's order.

    Tokens move packed by bucket. A sketch counter is no less than a token's frequency, so a bucket of light tokens is
    bounded; tokens of a heavy counter are dealt out by token and node, and all of them pass.
    """
    buckets = max(16, shingles // 4 // BUCKET_TOKENS)
    heavy = 4096 + 16 * int(shingles // SKETCH)
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> pa.RecordBatch:
            token, node, place = (np.concatenate(x) for x in zip(*held))
            light = shared.value[(token % U(SKETCH)).astype(np.int64)] < heavy
            deal = np.where(light, mix(token ^ _A), mix(token ^ mix(node)))
            bucket = (deal % U(buckets)).astype(np.int64) * 2 + ~light
            order = np.argsort(bucket, kind="stable")
            bucket, token, node, place = bucket[order], token[order], node[order], place[order]
            cut = np.concatenate([np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), [len(bucket)]])
            pieces = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[cut[:-1]]), pa.array([token[a:b].tobytes() for a, b in pieces], pa.binary()),
                    pa.array([node[a:b].tobytes() for a, b in pieces], pa.binary()), pa.array([place[a:b].tobytes() for a, b in pieces], pa.binary()),
                ],
                ["bucket", "tokens", "nodes", "places"],
            )

        for node, s in _new_sets(batches):
            first = _first(s, shared.value)
            held.append((first, np.full(len(first), U(node)), np.arange(len(first), dtype=np.int32)))
            size += len(first)
            if size > 1 << 19:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    def meet(table: pa.Table) -> pa.Table:
        token = np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint64)
        node = np.frombuffer(b"".join(table.column("nodes").to_pylist()), np.uint64)
        place = np.frombuffer(b"".join(table.column("places").to_pylist()), np.int32)
        if not table.column("bucket")[0].as_py() & 1:
            order = np.argsort(token, kind="stable")
            token, node, place = token[order], node[order], place[order]
            cut = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            several = np.minimum.reduceat(node, cut) != np.maximum.reduceat(node, cut)
            keep = np.repeat(several, np.diff(np.concatenate([cut, [len(token)]])))
            token, node, place = token[keep], node[keep], place[keep]
        return pa.table({"token": token.view(np.int64), "node": node.view(np.int64), "place": place})

    packed = texts.mapInArrow(pack, "bucket long, tokens binary, nodes binary, places binary")
    return packed.groupBy("bucket").applyInArrow(meet, "token long, node long, place int").distinct()


def _filter(nodes: DataFrame) -> np.ndarray:
    """A bitmap of node hashes, built in the tasks: it never misses a node."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(NODE_FILTER // 8, np.uint8)
        for b in batches:
            h = mix(b.column("node").to_numpy().view(np.uint64)) % U(NODE_FILTER)
            np.bitwise_or.at(bits, (h >> U(3)).astype(np.int64), (1 << (h & U(7))).astype(np.uint8))
        words = bits.view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], ["at", "bits"])

    got = nodes.mapInArrow(build, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # of bounded size
    out = np.zeros(NODE_FILTER // 64, np.int64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint8)


def _whole_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, tokens) of the wanted nodes."""
    shared = texts.sparkSession.sparkContext.broadcast(_filter(wanted))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], ["node", "n", "tokens"])

        for node, s in _new_sets(batches):
            h = int(mix(np.asarray([node], np.uint64))[0]) % NODE_FILTER
            if shared.value[h >> 3] >> (h & 7) & 1:
                rows.append((_signed(node), len(s), s.tobytes()))
                size += s.nbytes
                if size > 8 << 20:
                    yield out()
                    rows, size = [], 0
        if rows:
            yield out()

    found = texts.mapInArrow(pick, "node long, n long, tokens binary").join(wanted, "node", "left_semi")
    return found.groupBy("node").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))


def _among(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets of these nodes, and hardly any other, so that few are moved."""
    shared = sets.sparkSession.sparkContext.broadcast(_filter(nodes))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = mix(b.column("node").to_numpy().view(np.uint64)) % U(NODE_FILTER)
            yield b.filter(pa.array((shared.value[(h >> U(3)).astype(np.int64)] >> (h & U(7)).astype(np.uint8)) & 1 == 1))

    return sets.mapInArrow(pick, sets.schema)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are linked."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("tokens_a"), b.column("tokens_b")):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(s) > len(t):
                    s, t = t, s
                both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
                keep.append(DENOMINATOR * both >= NUMERATOR * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a"))
    two = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "tokens_a", "tokens_b").mapInArrow(check, "a long, b long")


def _fits(a: str, b: str) -> Column:
    return NUMERATOR * F.greatest(a, b) <= DENOMINATOR * F.least(a, b)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _may_link() -> Column:
    """Whether a shingle can be among the first SHARED that a node and a member of a group must share.

    A linked pair shares a = ceil(3/7 (n + m)) shingles, so the k-th of them is at place n - a + k of the node and
    m - a + k of the member at most. The group stands by the least a and the earliest place of its members.
    """
    least = F.greatest("lo", F.ceil(F.col("n") * NUMERATOR / DENOMINATOR))
    most = F.least("hi", F.floor(F.col("n") * DENOMINATOR / NUMERATOR))
    a = F.ceil((F.col("n") + least) * NUMERATOR / (NUMERATOR + DENOMINATOR))
    return (least <= most) & (F.col("place") + a <= F.col("n") + SHARED - 1) & (F.col("other_place") + a <= most + SHARED - 1)


def node_components(named: DataFrame, space: Space, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Of a frame of ``common.numbered``: ((row, id, n, node) per document, (node, component) of linked nodes); a text without words has n = 0."""
    base = named.select("row", F.col(f"whole.{id_col}").cast("long").alias("id"), F.col(f"whole.{text_col}").alias("text"))
    texts = base.select("text")
    profile = space.write(base.withColumn("part", F.spark_partition_id()).mapInArrow(_profile, PROFILE), "profile", keep=True)
    rows = profile.where("block IS NULL")
    nodes = rows.where("n > 0").groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", *LOWS)))
    shingles = nodes.agg(F.sum("n")).first()[0] or 0
    tokens = space.write(_shared_tokens(texts, _sketch(profile), shingles), "tokens")
    need = F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)
    some = F.least(F.lit(SHARED), F.ceil(need * NUMERATOR / DENOMINATOR))
    held = tokens.groupBy("node").agg(F.count(F.lit(1)).alias("held")).join(nodes, "node").where(F.col("held") >= some)
    common = F.col("held") / (F.col("n") - need + F.least(F.lit(SHARED), need))
    wanted = space.write(held.select("node", "n", *LOWS, some.alias("some"), common.alias("common")), "wanted")

    # members and leaders: of nodes with the same smallest hash the one whose shingles are held most by others
    lows = wanted.select("node", "n", "common", F.explode(F.array(*LOWS)).alias("low"))
    lead = F.max_by(F.struct("node", "n"), F.struct(F.col("common"), F.col("node")))
    leaders = lows.groupBy("low").agg(lead.alias("lead"), F.count(F.lit(1)).alias("many")).where("many > 1")
    stars = (
        lows.join(leaders, "low").where(F.col("node") != F.col("lead.node"))
        .select(F.col("lead.node").alias("a"), F.col("node").alias("b"), F.col("lead.n").alias("n_a"), F.col("n").alias("n_b"))
        .where(_fits("n_a", "n_b")).select("a", "b").distinct()
    )
    stars = space.write(stars, "stars")
    sets = space.write(_whole_sets(texts, _ends(stars)), "sets")
    near = space.write(_linked(stars, sets), "near")
    joined = components(space, near)

    # the matrix: groups of linked nodes of about one size against their unions of first shingles
    member = wanted.join(joined, "node", "left").select("node", "n", "some", F.coalesce("component", "node").alias("component"))
    member = member.withColumn("band", F.floor(F.log("n") / F.log(F.lit(BAND))))
    sizes = member.groupBy("component", "band").agg(F.count(F.lit(1)).alias("size"))
    split = F.struct("band", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / GROUP)).alias("split"))
    member = space.write(member.join(sizes, ["component", "band"]).select("node", "n", "some", "component", split.alias("part")), "members")
    held = tokens.join(member, "node")
    open_tokens = held.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    held = space.write(held.join(open_tokens, "token", "left_semi"), "held")
    matrix = held.groupBy("token", F.col("component").alias("other"), F.col("part").alias("other_part")).agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("place").alias("other_place")
    )
    opened = (
        held.join(matrix, (held.token == matrix.token) & (F.col("component") < F.col("other")) & _may_link())
        .groupBy("node", "n", "some", "other", "other_part").agg(F.count(F.lit(1)).alias("overlap"))
        .where("overlap >= some").select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("other").alias("component"), F.col("other_part").alias("part"))
    )
    pairs = (
        opened.join(member.select("component", "part", F.col("node").alias("b"), F.col("n").alias("n_b")), ["component", "part"])
        .where(_fits("n_a", "n_b")).select("a", "b")
    )
    pairs = space.write(pairs, "pairs")
    more = _ends(pairs).join(sets.select("node"), "node", "left_anti")
    more = space.write(_whole_sets(texts, space.write(more, "more")), "sets")
    far = space.write(_linked(pairs, _among(sets, _ends(pairs)).union(more)), "far")
    merged = components(space, near.union(far))
    return rows.select("row", "id", "n", "node"), space.write(merged, "components", keep=True)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs``, over 5-word shingles and a similarity of 0.75 or more.

    Texts with fewer words are one shingle. Null, empty and wordless texts have none and are linked with nothing: their
    component is their own id. Rows with equal sets are linked. A component's id is its smallest id that is not null.
    """
    with Space(docs.sparkSession) as space:
        rows, merged = node_components(numbered(docs, space), space, id_col, text_col)
    least = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("low"))
    placed = least.join(merged, "node", "left").select("node", "low", F.coalesce("component", "node").alias("component"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    named = placed.join(lowest, "component").select("node", "component_id")
    return rows.join(named, "node", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does: the one of smallest id, null last.

    Texts without words are linked with nothing and all stay. Of rows equal in id and text one stays.
    """
    with Space(docs.sparkSession) as space:
        named = numbered(docs, space)
        rows, merged = node_components(named, space, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    best = rows.where("n > 0").groupBy("node").agg(F.min(order).alias("best")).join(merged, "node", "left")
    stay = best.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("best").alias("best")).select("best.row")
    dropped = rows.where("n > 0").select("row").join(stay, "row", "left_anti")
    return named.join(dropped, "row", "left_anti").select("whole.*")

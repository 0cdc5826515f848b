"""SentencePiece encoding and decoding by shared-prefix Viterbi.

The distinct marked words of a batch are sorted, which lays them out as a trie in depth-first order; the forward
state of a position depends on the prefix alone, so a word goes on from where it parts from the word before it.

For a unigram model an edge is any piece and the best sum of scores wins. For a BPE model an edge is allowed only
if it is what merging leaves of the two pieces side by side; then exactly one path is left, the merge result (a
sequence is the merge result if and only if all its neighbours are).

The pieces that end at a position come from an automaton over the beginnings of pieces, which makes one step a character.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the file format
UNIGRAM, BPE = 1, 2  # model types of the file format
CACHE_BYTES = 80 << 20  # of words that a task remembers
CACHE_EDGES = 1 << 18  # of piece pairs
CACHE_STEPS = 1 << 18  # of the automaton
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            n, at = varint(at)
            value, at = data[at : at + n], at + n
        else:
            n = 4 if kind == 5 else 8
            value, at = data[at : at + n], at + n
        yield tag >> 3, value


class _Follows(dict):
    """For one piece: whether it may stand right of the piece that is asked for."""

    __slots__ = ("codec", "piece")

    def __init__(self, codec: Codec, piece: str) -> None:
        self.codec, self.piece = codec, piece

    def __missing__(self, before: str) -> bool:
        known = self.codec._edge(before, self.piece)
        if self.codec.edges >= CACHE_EDGES:
            for x in self.codec.follows.values():
                x.clear()
            self.codec.edges = 0
        self.codec.edges += 1
        self[before] = known
        return known


class _State(dict):
    """The longest end of what was read that begins a piece, with the pieces that end here; by the next character, the state after it."""

    __slots__ = ("codec", "held", "ending")

    def __init__(self, codec: Codec, held: str) -> None:
        self.codec, self.held = codec, held
        found = [held[-k:] for k in range(len(held), 1, -1) if held[-k:] in codec.ids]
        if codec.kind == BPE:
            self.ending = tuple((len(p), p, codec._follows(p)) for p in found)
        else:
            self.ending = tuple((len(p), p, codec.scores[codec.ids[p]]) for p in found)

    def __missing__(self, c: str) -> _State:
        codec, held = self.codec, self.held + c
        while held and held not in codec.beginnings:
            held = held[1:]
        state = codec._state(held)
        if codec.steps < CACHE_STEPS:
            codec.steps += 1
            self[c] = state
        return state


class Codec:
    """A model file's vocabulary, with encoding to and decoding from little-endian int32 bytes."""

    def __init__(self, model: bytes) -> None:
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.kind, self.prefix, self.squeeze = UNIGRAM, True, True
        for field, value in _fields(model):
            if field == 1:
                one = dict(_fields(value))
                self.pieces.append(one[1].decode())
                self.scores.append(struct.unpack("<f", one[2])[0] if 2 in one else 0.0)
                self.types.append(one.get(3, NORMAL))
            elif field == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                spec = dict(_fields(value))
                self.prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
                if spec.get(2) or not spec.get(5, 1):
                    raise ValueError("models with a character map or unescaped spaces are not supported")
        if USER in self.types or self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models without user-defined pieces are supported")
        self._prepare()

    def _prepare(self) -> None:
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.types[i] == NORMAL}
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece spans two words")
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\t\r" if c not in joined)  # no piece reaches across these
        end = re.escape(MARK + alone)
        self.splitter = re.compile(f"{MARK}+[^{end}]*|[^{end}]+" + (f"|[{re.escape(alone)}]" if alone else ""))
        self.floor = min((self.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        self.beginnings = {p[:k] for p in self.ids if len(p) > 1 for k in range(1, len(p) + 1)}
        self._forget()
        self.text = [b"" if t in (CONTROL, UNKNOWN, UNUSED) else p.replace(MARK, " ").encode() for p, t in zip(self.pieces, self.types)]
        self.text[self.unknown] = " ⁇ ".encode()
        for value, i in self.bytes.items():
            self.text[i] = bytes([value])
        self.codes = {p: (struct.pack("<i", i), self.text[i]) for p, i in self.ids.items()}  # ids, and what they decode to
        self._merge_trees()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("follows", "edges", "states", "steps", "words", "back", "held", "odd_here")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._forget()

    def _forget(self) -> None:
        """The memory of a task: ids and decoded bytes of words, states, and which pieces may stand side by side."""
        self.follows: dict[str, _Follows] = {}
        self.edges = 0  # piece pairs in it
        self._restart()
        self.words: dict[str, bytes] = {}
        self.back: dict[str, bytes] = {}  # of words that do not come back as themselves
        self.odd_here = False  # whether the last texts held any of those
        self.held = 0

    def _restart(self) -> None:
        self.states: dict[str, _State] = {}
        self.steps = 0

    def _state(self, held: str) -> _State:
        found = self.states.get(held)
        if found is None:
            found = self.states[held] = _State(self, held)
        return found

    def _follows(self, piece: str) -> _Follows:
        found = self.follows.get(piece)
        if found is None:
            found = self.follows[piece] = _Follows(self, piece)
        return found

    def _merge_trees(self) -> None:
        """Which two pieces merging makes each piece of last, for pieces that it makes, from pieces of better score.

        ``turn`` is the place of a piece's score in the order of scores; ``made`` has it for pieces with trees only.
        """
        self.turn: dict[str, int] = {}
        self.made: dict[str, int] = {}
        self.tree: dict[str, tuple[str, str]] = {}
        if self.kind != BPE:
            return
        order = sorted((p for p in self.ids if len(p) > 1), key=lambda p: -self.scores[self.ids[p]])
        places = {score: k for k, score in enumerate(sorted({-self.scores[self.ids[p]] for p in order}))}
        self.turn = {p: places[-self.scores[self.ids[p]]] for p in order}
        for p in order:
            last = self._merged(p, 2)
            ready = all(x in self.ids if len(x) == 1 else x in self.tree and self.turn[x] <= self.turn[p] for x in last)
            if len(last) == 2 and ready and self._merged(p) == [p]:
                self.tree[p] = (last[0], last[1])
                self.made[p] = self.turn[p]

    def _apart(self, left: str, right: str) -> bool:
        """Whether merging leaves two pieces side by side that have trees or are single characters.

        Their merges are undone from the last to the first. Whatever two pieces meet at the border in between must not be a
        piece that would be made before the merge that was undone there; of equal ones the left one is made first.
        """
        turn, tree, made, limit = self.turn.get, self.tree, self.made.get, len(self.turn)
        a, b = made(left, -1), made(right, -1)
        while True:
            if turn(left + right, limit) < limit:
                return False
            if a > b:
                limit, left = a, tree[left][1]
                a = made(left, -1)
            elif b >= 0:
                limit, right = b + 1, tree[right][0]
                b = made(right, -1)
            else:
                return True

    def _merged(self, text: str, least: int = 1) -> list[str]:
        """Repeatedly join the neighbours of best score, leftmost first, until ``least`` are left."""
        parts = list(text)
        while len(parts) > least:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, before: str, piece: str) -> bool:
        """Whether merging leaves the two pieces side by side; the first may be empty."""
        tree, ids = self.tree, self.ids
        if before and (piece in tree or len(piece) == 1 and piece in ids) and (before in tree or len(before) == 1 and before in ids):
            return self._apart(before, piece)
        return self._merged(before + piece) == ([before, piece] if before else [piece])

    def _ids(self, pieces: list[str]) -> list[int]:
        out = list(map(self.ids.get, pieces))
        if None not in out:
            return out
        out = []
        for p in pieces:
            found = self.ids.get(p)
            if found is not None:
                out.append(found)
            elif self.bytes:
                out += [self.bytes[b] for b in p.encode()]
            elif not out or out[-1] != self.unknown or self.kind == BPE:  # unigram joins neighbours that are unknown
                out.append(self.unknown)
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Forward scores of distinct words, in sorted order, kept along the common prefix of each two."""
        if self.steps >= CACHE_STEPS:
            self._restart()
        last: list[str] = [""]  # the piece that ends at each position
        score: list[float] = [0.0]
        start, bpe, ids, scores, floor, codes, text = self._state(""), self.kind == BPE, self.ids, self.scores, self.floor, self.codes, self.text
        before = ""
        for word in sorted(words):
            shared, state = 0, start
            for c, d in zip(before, word):
                if c != d:
                    break
                state = state[c]
                shared += 1
            del last[shared + 1 :], score[shared + 1 :]
            if bpe:  # one path is left: a piece that may follow the piece before it
                for c in word[shared:]:
                    state = state[c]
                    for size, piece, follows in state.ending:
                        if follows[last[-size]]:
                            break
                    else:
                        piece = c
                    last.append(piece)
            else:
                for c in word[shared:]:
                    state = state[c]
                    best, piece = score[-1] + (floor if c not in ids else scores[ids[c]]), c
                    for size, longer, own in state.ending[::-1]:
                        if score[-size] + own >= best:
                            best, piece = score[-size] + own, longer
                    last.append(piece)
                    score.append(best)
            path, i = [], len(word)
            while i:
                piece = last[i]
                path.append(piece)
                i -= len(piece)
            path.reverse()
            try:
                known = [codes[p] for p in path]
                self.words[word] = b"".join([code for code, _ in known])
                decoded = b"".join([back for _, back in known])
            except KeyError:
                found = self._ids(path)
                self.words[word] = struct.pack(f"<{len(found)}i", *found)
                decoded = b"".join([text[k] for k in found])
            if decoded != word.replace(MARK, " ").encode():
                self.back[word] = decoded
            self.held += _cost(word)
            before = word

    def marked(self, text: str) -> list[str]:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return []
        return self.splitter.findall((MARK if self.prefix else "") + text.replace(" ", MARK))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian int32; null and empty texts have none."""
        split = self._learned(texts)
        return [b"".join(map(self.words.__getitem__, s)) for s in split]

    def both_ways(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """(ids, the bytes they decode to) per text.

        Decoding joins what pieces stand for, so a word is decoded once, when it is learned. Where every word of these texts
        came back as itself, and marks are the texts' spaces and nothing else, the whole text did.
        """
        split = self._learned(texts)
        ids, back, plain = self.words.__getitem__, self.back.get, not (self.squeeze or self.odd_here)
        out = []
        for s, text in zip(split, texts):
            if plain and MARK not in (text or ""):
                found = (text or "").encode()
            else:
                found = self._unmarked(b"".join([_spaced(w) if (b := back(w)) is None else b for w in s]))
            out.append((b"".join(map(ids, s)), found))
        return out

    def _learned(self, texts: list[str | None]) -> list[list[str]]:
        split = [self.marked(t or "") for t in texts]
        here: set[str] = set()
        for s in split:
            here.update(s)
        new = here.difference(self.words)
        if self.held > CACHE_BYTES:  # what is met again stays
            again = here - new
            self.words = {w: self.words[w] for w in again}
            self.back = {w: b for w, b in self.back.items() if w in again}
            self.held = sum(map(_cost, again))
        self.learn(new)
        self.odd_here = not here.isdisjoint(self.back)
        return split

    def _unmarked(self, out: bytes) -> bytes:
        return out[1:] if self.prefix and out[:1] == b" " else out

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, the mark of the first word goes."""
        out = b"".join([self.text[i] for i in np.frombuffer(ids, "<i4").tolist()])
        return self._unmarked(out).decode("utf-8", "replace")


def _cost(word: str) -> int:
    """Bytes that a remembered word takes, roughly."""
    return 220 + 4 * len(word)


def _spaced(word: str) -> bytes:
    return word.replace(MARK, " ").encode()


def load(path: str) -> Codec:
    with open(path, "rb") as f:
        return Codec(f.read())


def _groups(texts: list, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Runs of about ``most`` characters; a longer text is a run of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t is not None else 0
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, codec: Codec, text_col: str = "text", carried: list[str] | None = None) -> DataFrame:
    """(whole, ids array<int>, round_trip) per row: whether decoding gives the text back; null counts as empty.

    ``whole`` has the columns named in ``carried``, or all of them. Empty texts have no ids and come back as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)  # a vocabulary: of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = b.column("whole")
            text = (b.column("text") if carried is not None else pc.struct_field(whole, [b.schema.field("whole").type.get_field_index(text_col)])).to_pylist()
            for start, end in _groups(text):
                got = shared.value.both_ways(text[start:end])
                at = np.concatenate([[0], np.cumsum([len(g) // 4 for g, _ in got])]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join([g for g, _ in got]), "<i4"), pa.int32())
                ids = pa.ListArray.from_arrays(pa.array(at), flat)
                same = pa.array([d == (t or "").encode() for (_, d), t in zip(got, text[start:end])], pa.bool_())
                yield pa.RecordBatch.from_arrays([whole.slice(start, end - start), ids, same], ["whole", "ids", "round_trip"])
        shared.value._forget()

    base = docs.select(F.struct("*").alias("whole"))
    if carried is not None:
        base = docs.select(F.struct(*carried).alias("whole"), F.col(text_col).alias("text"))
    schema = base.select("whole", F.array(F.lit(0)).alias("ids"), F.lit(True).alias("round_trip")).schema
    return base.mapInArrow(run, schema)


def decode(encoded: DataFrame, codec: Codec, ids_col: str = "ids") -> DataFrame:
    """(whole, text) per row of a frame with an array of ids; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [None if x is None else shared.value.decode(struct.pack(f"<{len(x)}i", *x)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("whole"), pa.array(out, pa.string())], ["whole", "text"])

    base = encoded.select(F.struct("*").alias("whole"), F.col(ids_col).alias("ids"))
    return base.mapInArrow(run, base.select("whole", F.lit("").alias("text")).schema)


DIGEST = "doc_id long, n_tokens long, n_fallback long, ids_sha256 string, decoded_sha256 string, round_trip boolean"


def round_trips(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of encoding and decoding every whole text: counts, hash of the ids, hash of the decoded text.

    ``n_fallback`` counts byte and unknown pieces. A null text counts as empty. ``round_trip`` is false where the
    text itself holds the word mark, or white space that the model squeezes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        odd = np.asarray([t in (BYTE, UNKNOWN) for t in codec.types])
        for b in batches:
            doc, text = b.column("doc_id"), b.column("text").to_pylist()
            for start, end in _groups(text):
                rows = []
                for (g, d), t in zip(codec.both_ways(text[start:end]), text[start:end]):
                    same = d == (t or "").encode()
                    if not same:
                        d = d.decode("utf-8", "replace").encode()
                    rows.append((len(g) // 4, int(odd[np.frombuffer(g, "<i4")].sum()), hashlib.sha256(g).hexdigest(), hashlib.sha256(d).hexdigest(), same))
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
                names = ["doc_id", "n_tokens", "n_fallback", "ids_sha256", "decoded_sha256", "round_trip"]
                yield pa.RecordBatch.from_arrays([doc.slice(start, end - start), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)
        codec._forget()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, DIGEST)

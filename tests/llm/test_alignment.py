"""Cross-tokenizer alignment against both libraries and a plain loop."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pennant.llm.common import Space, ship_code
from pennant.llm.queries import BYTE_LEVEL_FILE, SENTENCEPIECE_MODEL, op12_token_alignment
from pennant.llm.token_alignment import BLOCK_SCHEMA, GROUP, SLICE, Aligner, _arrow, _short, align, compose, fragment, ranges, visible_bytes

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
A_FILE, B_FILE = open(BYTE_LEVEL_FILE, "rb").read(), open(SENTENCEPIECE_MODEL, "rb").read()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_str(A_FILE.decode())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_proto=B_FILE)


def brute(libraries, rows):
    a, b = libraries
    of = visible_bytes()
    docs, counts = [], Counter()
    for doc, text in rows:
        raw = b" " + (text or "").encode()
        x = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        y = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]] if text else []
        if not text or b"".join(t for _, t in x) != raw or b"".join(t for _, t in y) != raw:
            docs.append((doc, [], [], [], []))
            continue
        xs, ys = np.cumsum([len(t) for _, t in x]).tolist(), np.cumsum([len(t) for _, t in y]).tolist()
        links, i, j, groups, ga, gb = [], 0, 0, [], [], []
        while i < len(x):
            links.append((x[i][0], y[j][0]))
            done = xs[i], ys[j]
            if done[0] <= done[1]:
                ga.append(x[i][0])
                i += 1
            if done[1] <= done[0]:
                gb.append(y[j][0])
                j += 1
            if done[0] == done[1]:
                groups.append((ga, gb))
                ga, gb = [], []
        counts.update(links)
        docs.append((doc, x, y, groups, links))
    best = Counter()
    for (p, q), c in counts.items():
        best[q] = max(best[q], c)
    out = []
    for doc, x, y, groups, links in docs:
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((doc, len(x), len(y), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), sha))
    return Counter(out)


def some_texts(seed, n, words):
    rng = random.Random(seed)
    parts = ["the", "Straße", "日本語", "don't", "x", "1234567", "  ", "\n\n", "\t", "😀", "naïve", "<s>", "<0x41>", "<|endoftext|>", "tokenization", "--", "\x00", "é", "мир", "pseudopseudo"]
    return ["".join(rng.choice(parts) + rng.choice([" ", " ", "", "\n"]) for _ in range(rng.randint(1, words))) for _ in range(n)]


def frame(spark, rows):
    ship_code(spark)
    return spark.createDataFrame([(i, t, b"k", 1, "b") for i, t in rows], "doc_id long, text string, key binary, k int, block string")


ROWS = [(i, t) for i, t in enumerate(some_texts(1, 60, 40))] + [
    (None, "null id"), (5, "twice"), (5, "twice"), (70, None), (71, ""), (72, " "), (73, "   "), (74, "▁ marked"), (75, "a ▁"), (76, "x" * 3000), (77, "end \n"),
    (78, "no_space_" * 300), (79, "日本" * 400), (80, "▁ " + "long text " * 90),
]


@pytest.mark.parametrize("size", [1 << 16, 64, 7])
def test_matches_brute_force_for_any_range(spark, libraries, size):
    rows = ROWS if size > 7 else ROWS[:30] + ROWS[-8:]
    got = align(frame(spark, rows), A_FILE, B_FILE, range_bytes=size)
    assert got.columns == COLUMNS
    assert Counter(tuple(r) for r in got.collect()) == brute(libraries, rows)


def test_ranges_cover_the_text_and_start_at_safe_points():
    text = (" " + "".join(some_texts(3, 20, 100))).encode()
    found = list(ranges(text, 100))
    assert found[0][0] == 0 and found[-1][1] == len(text) and all(x[1] == y[0] for x, y in zip(found, found[1:]))
    assert all(start <= low and end >= high for low, high, start, end in found)
    assert list(ranges(b" " + b"x" * 5000, 100)) == [(0, 5001, 0, 5001)]


def test_composition_is_associative():
    model = Aligner(A_FILE, B_FILE)
    text = (" " + " ".join(f"pseudo{i}tokenization" for i in range(40))).encode()
    parts = []
    for k, (low, high, start, end) in enumerate(ranges(text, 5)):
        row = {"key": b"", "doc_id": 1, "k": k, "lo": low, "hi": high, "start": start, "text": text[start:end]}
        parts.append(fragment(model, row) | {"first": k})
    plain = [{k: ({n: np.asarray(x).tolist() for n, x in v.items()} if isinstance(v, dict) else v) for k, v in p.items() if k in ("has", "head", "tail", "first")} for p in parts]

    def fold(items, rng):
        items, bridges = list(items), []
        while len(items) > 1:
            i = rng.randrange(len(items) - 1)
            items[i : i + 2], bridge = [compose(items[i], items[i + 1])[0]], compose(items[i], items[i + 1])[1]
            bridges += [bridge] if bridge else []
        return items[0], sorted(bridges, key=lambda b: b[0])

    first = fold(plain, random.Random(0))
    assert len(parts) > 50 and len(first[1]) > 10
    assert all(fold(plain, random.Random(s)) == first for s in range(1, 6))


def test_encoder_gives_way_on_very_many_spaces(libraries):
    text = "a" + " " * 1_500_000 + "b"
    assert Aligner(A_FILE, B_FILE).a.encode(text).tolist() == libraries[0].encode(text, add_special_tokens=False).ids


def test_encoders_agree_on_every_character(libraries):
    model = Aligner(A_FILE, B_FILE).a
    for low in range(0, 0x110000, 1 << 12):
        chars = [chr(c) for c in range(low, low + (1 << 12)) if not 0xD800 <= c < 0xE000]
        for text in ("".join(f" a{c}b1{c}" for c in chars), "".join(f"{c}{c} ?{c}\n" for c in chars)):
            assert model.encode(text).tolist() == libraries[0].encode(text, add_special_tokens=False).ids


def many_words(libraries, seed, size):
    rng, b = random.Random(seed), libraries[1]
    parts = [p for i in range(b.get_piece_size()) if not b.is_byte(i) and (p := b.id_to_piece(i).strip("▁")).isalpha()]
    return [" ".join("".join(rng.choices(parts, k=2)) for _ in range(200)) for _ in range(size)]


class Sent:
    value = A_FILE, B_FILE


def test_rows_of_a_block_are_small_and_make_it_up(spark, libraries):
    found, schema = many_words(libraries, 1, 1300), _arrow(spark, BLOCK_SCHEMA)
    batch = pa.RecordBatch.from_pydict({"doc_id": [*range(len(found)), None], "text": [*found, None]})
    out = list(_short(Sent, schema)([batch]))
    assert sum(map(len, found)) > 2 << 20 and max(b.nbytes for b in out) < 1 << 20
    rows = [r for b in out for r in b.to_pylist()]
    assert [i for r in rows for i in r["ids"]] == [*range(len(found)), None]
    assert len({r["block"] for r in rows}) == 1  # under BLOCK bytes
    pairs, times = ([x for r in rows for x in r[c]] for c in ("pairs", "times"))
    assert [r["base"] for r in rows] == [min(i * SLICE, len(pairs)) for i in range(len(rows))]
    assert len(pairs) > 2 * SLICE and pairs == sorted(set(pairs))
    links = np.concatenate([np.frombuffer(r["links"], "<u4") for r in rows])
    assert [len(r["links"]) // 4 for r in rows] == [sum(r["n_links"]) for r in rows]
    assert np.bincount(links, minlength=len(pairs)).tolist() == times


def test_many_pairs_in_a_block_match_brute_force(spark, libraries):
    rows = list(enumerate(many_words(libraries, 2, 700)))
    assert Counter(tuple(r) for r in align(frame(spark, rows), A_FILE, B_FILE).coalesce(1).collect()) == brute(libraries, rows)


def test_large_rows_are_written_in_small_groups(spark, tmp_path):
    rng = np.random.default_rng(1)
    spark.createDataFrame([(rng.bytes(1 << 20),) for _ in range(60)], "x binary").coalesce(1).write.parquet(f"{tmp_path}/in")
    with Space(spark) as space:
        written = space.write(spark.read.parquet(f"{tmp_path}/in").coalesce(1), "rows", group=GROUP)
        for name in written.inputFiles():
            file = pq.ParquetFile(name.removeprefix("file://")).metadata
            assert all(file.row_group(i).total_byte_size <= 2 * GROUP for i in range(file.num_row_groups))


def test_empty_table(spark):
    assert align(frame(spark, []), A_FILE, B_FILE).count() == 0


def test_query_over_the_whole_table(spark, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in op12_token_alignment(spark, sf).collect()) == brute(libraries, rows)

"""Codec, decontamination, language ID, quality, LM scores, URL filter and HTML extraction."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from pennant.llm import sentencepiece_codec as sp
from pennant.llm.common import ship_code
from pennant.llm.decontaminate import NAME, NUM, SHARE, UNIT, WINDOW, Words, contaminated, decontaminate, plain_hashes, templates, word_class
from pennant.llm.html_extract import FEATURES, PRIOR, extract, fit, labels, main_text, min_cut, parse
from pennant.llm.language_id import keep_known, languages
from pennant.llm.lm_score import lm_scores
from pennant.llm.quality import quality
from pennant.llm.queries import SENTENCEPIECE_MODEL, URL_RULES
from pennant.llm.url_filter import rule_table, url_verdicts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, whole string, held string, letter string, key string"
TRICKY = [
    "", "   ", " a  b ", "\n\n x\t y\r\n", "日本語 テキスト 😀😀", "a\x00b", "<s> </s> <0x41>", "antidisestablishmentarianism", "ÀÉ éé", "x" * 3000,
]


def docs_of(spark, rows):
    """Rows of (doc_id, text, lang), with columns whose names the operators use themselves."""
    ship_code(spark)
    return spark.createDataFrame([(i, t, x, "src", None if t is None else len(t), 1, "w", "h", "l", "k") for i, t, x in rows], SCHEMA)


@pytest.fixture(scope="module")
def codec():
    return sp.load(SENTENCEPIECE_MODEL)


@pytest.fixture(scope="module")
def sf_texts(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]


def test_encoding_equals_the_library(codec, sf_texts):
    library = sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)
    texts = [*sf_texts, *TRICKY]
    got = [np.frombuffer(x, "<i4").tolist() for x in codec.encode(texts)]
    assert got == library.encode(texts)
    assert [codec.decode(x) for x in codec.encode(texts)] == library.decode(library.encode(texts))


def test_borders_that_merging_leaves(codec):
    """By undoing merges, against merging; pieces at random, and pairs of short ones."""
    rng = random.Random(12)
    pieces = [p for p in codec.ids if p in codec.tree or len(p) == 1]
    assert len(codec.tree) > 20_000
    pairs = [(rng.choice(pieces), rng.choice(pieces)) for _ in range(20_000)]
    short = [p for p in pieces if len(p) < 4 and all(c.isascii() for c in p)]
    pairs += [(rng.choice(short), rng.choice(short)) for _ in range(60_000)] + [(a, a) for a in short[:3000]]
    wrong = [(a, b) for a, b in pairs if codec._apart(a, b) != (codec._merged(a + b) == [a, b])]
    assert not wrong


def test_encoding_survives_when_its_memory_is_full(sf_texts, monkeypatch):
    monkeypatch.setattr(sp, "CACHE_BYTES", 20_000)
    monkeypatch.setattr(sp, "CACHE_EDGES", 50)
    small, library = sp.load(SENTENCEPIECE_MODEL), sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)
    for start in range(0, 100, 7):
        texts = sf_texts[start : start + 7]
        got = small.both_ways(texts)
        assert [np.frombuffer(g, "<i4").tolist() for g, _ in got] == library.encode(texts) and [d.decode() for _, d in got] == texts
    assert small.held < 2_000_000  # a batch of its own at most


def test_only_pieces_that_end_at_a_position_are_tried(codec, sf_texts, monkeypatch):
    for word in {w for t in [*sf_texts[:40], *TRICKY] for w in codec.marked(t)}:
        state = codec._state("")
        for i, c in enumerate(word, 1):
            state = state[c]
            assert [p for _, p, _ in state.ending] == [word[i - k : i] for k in range(min(i, 40), 1, -1) if word[i - k : i] in codec.ids]
    monkeypatch.setattr(sp, "CACHE_STEPS", 20)
    monkeypatch.setattr(sp, "CACHE_EDGES", 50)
    small = sp.load(SENTENCEPIECE_MODEL)
    assert small.encode(sf_texts[:30]) == codec.encode(sf_texts[:30])
    assert small.steps <= 20 and sum(map(len, small.states.values())) <= 20 and sum(map(len, small.follows.values())) <= 50
    assert max(map(len, codec.ids)) <= 40


def test_unigram_takes_the_best_sum_of_scores():
    rng = random.Random(1)
    one = sp.Codec.__new__(sp.Codec)
    pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): -rng.random() * 8 for _ in range(25)} | {"▁": -2.0, "▁a": -2.5, "b": -9.0, "a": -9.5}
    one.pieces, one.scores = ["<unk>", *pieces], [0.0, *pieces.values()]
    one.types, one.kind, one.prefix, one.squeeze = [sp.UNKNOWN] + [sp.NORMAL] * len(pieces), sp.UNIGRAM, True, True
    one._prepare()

    def best(word):
        if not word:
            return 0.0
        found = [(pieces[word[:k]] if word[:k] in pieces else one.floor) + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in pieces or k == 1]
        return max(found)

    words = {"▁" + "".join(rng.choice("abcz") for _ in range(rng.randint(0, 8))) for _ in range(60)}
    one.learn(words)
    for w in words:
        ids = np.frombuffer(one.words[w], "<i4").tolist()
        if 0 not in ids:
            assert math.isclose(sum(one.scores[i] for i in ids), best(w), abs_tol=1e-9)


def test_codec_frames(spark, codec):
    rows = [(i, t, None) for i, t in enumerate(TRICKY)] + [(None, None, None), (3, TRICKY[3], None), (77, "▁ mark", None)]
    docs = docs_of(spark, rows)
    encoded = sp.encode(docs, codec).select("whole.doc_id", "whole.text", "ids", "round_trip")
    back = sp.decode(encoded, codec).select("whole.*", F_text()).collect()
    assert len(back) == len(rows)
    for r in back:
        assert r.round_trip == (r.decoded == (r.text or "")) and r.round_trip == (r.doc_id != 77)
    digests = sp.round_trips(docs, codec).collect()
    assert Counter((r.doc_id, r.round_trip) for r in digests) == Counter((r.doc_id, r.round_trip) for r in back)
    assert sp.round_trips(docs_of(spark, []), codec).count() == 0


def F_text():
    from pyspark.sql import functions as F

    return F.col("text").alias("decoded")


ITEM = "A train leaves Boston at 7 pm and travels 120 km in 3 hours . How fast did Maria drive if she left at 7 pm too ?"


def test_decontamination(spark):
    rng = random.Random(2)
    noise = lambda n: " ".join(rng.choice("the of and to in is that for on with as it".split()) + rng.choice("abcdefgh") for _ in range(n))
    moved = ITEM.replace("Boston", "Denver").replace("7", "9").replace("120", "260").replace("Maria", "Peter")
    mixed = ITEM.replace("7 pm and", "9 pm and")  # one 7 became 9, the other did not
    rows = [
        (1, noise(40) + " " + ITEM + " " + noise(40), None), (2, noise(3) + " " + moved, None), (3, noise(200), None), (4, ITEM[:40], None),
        (5, None, None), (6, "", None), (7, "1 2 3 4 5 6 7 8", None), (None, moved, None), (2, noise(3) + " " + moved, None), (8, noise(30_000) + " " + ITEM, None),
        (9, noise(5) + " " + mixed, None),
    ]
    ship_code(spark)
    bench = spark.createDataFrame([(1, ITEM, 0), (1, ITEM, 0), (2, None, 0), (3, "", 0), (None, noise(30), 0), (4, "9 9 9 9 9 9 9", 0)], "item_id long, text string, row long")
    got = contaminated(docs_of(spark, rows), bench).collect()
    assert Counter((r.doc_id, r.item_id, r.exact_slots) for r in got) == Counter([(1, 1, True), (2, 1, False), (2, 1, False), (None, 1, False), (8, 1, True), (9, 1, False)])
    kept = decontaminate(docs_of(spark, rows), bench)
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7]
    assert contaminated(docs_of(spark, []), bench).count() == 0
    assert decontaminate(docs_of(spark, rows), bench.limit(0)).count() == len(rows)


def template(text):
    """Word by word: [(token, plain, value or None)]."""
    out, opening, before = [], True, 0
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        low, kind, closes = word_class(word)
        plain = int(plain_hashes([low])[0])
        if low:
            if kind == NAME and opening or kind == UNIT and before != NUM:
                kind = 0
            before = kind
            out.append((kind or plain, plain, low if kind else None))
        opening = closes
    return out


def brute_windows(text):
    found, n = template(text), 0
    for i in range(max(1, len(found) - WINDOW + 1) if found else 0):
        part = found[i : i + WINDOW]
        bare = all(v is not None for _, _, v in part)
        yield (tuple(p if bare else t for t, p, _ in part), i, [v for _, _, v in part])


def brute_leaks(rows, items):
    out = Counter()
    mine = [(doc, list(brute_windows(text))) for doc, text in rows]
    for item, text in items:
        theirs = list(brute_windows(text))
        size = len({w for w, _, _ in theirs})
        for doc, windows in mine:
            runs = {}
            for w, i, got in windows:
                for v, j, slots in theirs:
                    if v == w:
                        runs.setdefault(i - j, []).append((w, [(a, b) for a, b in zip(slots, got) if a is not None]))
            held = {}
            for run in runs.values():
                count = Counter(p for _, pairs in run for p in pairs)
                rank = {p: (n, p[0] == p[1], p[1], p[0]) for p, n in count.items()}
                odd = {p for p in count if any((q[0] == p[0] or q[1] == p[1]) and rank[q] > rank[p] for q in count)}
                for w, pairs in run:
                    if not odd & set(pairs):
                        held[w] = held.get(w, False) or all(x == y for x, y in pairs)
            if held and len(held) >= SHARE * size:
                out[doc, item, len(held), all(held.values())] += 1
    return out


def questions(rng, n):
    names, things = "Anna Boston Peter Maria Denver Lima Otto Rosa Berlin Paris".split(), "train boat bus crate farm shop river tower garden school".split()
    verbs, more = "sells carries holds needs finds builds moves counts paints cleans".split(), "quickly every morning while others wait near the old gate".split()
    for i in range(n):
        a, b = rng.sample(names, 2)
        x, y, z = rng.sample(range(2, 400), 3)
        yield i, (
            f"The {rng.choice(things)} of {a} {rng.choice(verbs)} {x} km in {y} hours and then {rng.choice(verbs)} {rng.choice(more)} with {b} for {z} dollars . "
            f"How many {rng.choice(things)}s does {a} have {rng.choice(more)} after {y} hours if {b} {rng.choice(verbs)} {rng.choice(more)} {x} {rng.choice(things)}s ?"
        )


def renamed(text, rng, odd):
    """Each number and name as another, everywhere alike, but for ``odd`` of the numbers."""
    other = {}
    words = text.split()
    for k, w in enumerate(words):
        if w.isdigit():
            words[k] = other.setdefault(w, str(rng.randint(500, 99_999)))
        elif w[0].isupper() and k and words[k - 1] != ".":
            words[k] = other.setdefault(w, rng.choice("Zoe Yves Xenia Walter Vera Udo Tom Sven".split()) + "abcdefghij"[len(other)])
    for k in rng.sample([i for i, w in enumerate(words) if w.isdigit()], odd):
        words[k] = str(rng.randint(100_000, 999_999))
    return " ".join(words)


def test_leaks_match_brute_force_and_edits_are_caught(spark):
    rng = random.Random(8)
    items = list(questions(rng, 40)) + [(100, "2 3 5 7 11 13 17"), (101, "Short one")]
    noise = lambda n: " ".join(rng.choice("the of and to in is Anna 3 km that .".split()) + rng.choice(["", "", "x", ","]) for _ in range(n))
    rows, planted = [], []
    for i, text in items[:40]:
        for odd in (0, 1):
            planted.append((len(rows), i))
            rows.append((len(rows), f"{noise(30)} . {renamed(text, rng, odd)} {noise(20)}"))
    rows += [(1000 + k, noise(80)) for k in range(20)] + [(2000, "1 2 3 5 7 11 13 17 19"), (2001, "Short one"), (2002, None), (2003, items[3][1])]
    ship_code(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contaminated(docs_of(spark, [(i, t, None) for i, t in rows]), bench).collect()
    assert Counter((r.doc_id, r.item_id, r.n_windows, r.exact_slots) for r in got) == brute_leaks(rows, items)
    caught = {(r.doc_id, r.item_id) for r in got}
    assert sum(p in caught for p in planted) >= 0.9 * len(planted)
    assert not any(1000 <= d < 1100 for d, _ in caught)


def test_like_worded_items_meet_their_texts_only(spark):
    items = [(i, f"What is the price of {i + 10} apples if one apple costs {i + 500} cents in the shop today ?") for i in range(300)]
    ship_code(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "What is the price of tea in the shop today ?", None), (2, items[7][1], None)]
    got = contaminated(docs_of(spark, rows), bench).collect()
    assert {r.doc_id for r in got} == {2} and [r.item_id for r in got if r.exact_slots] == [7]


def test_template_types():
    text = "On Monday Anna ran 3.5 km (ten percent) in 20kg."
    raw = np.frombuffer((text + "Ende km 5 km").encode(), np.uint8)
    words = Words()
    tokens, plains, row, starts, ends = templates(raw, np.asarray([0, len(text), len(raw)]), words)
    slots = [word_class(raw[a:z].tobytes().decode())[0] if t != p else None for t, p, a, z in zip(tokens, plains, starts, ends)]
    assert [s for s in slots if s] == ["monday", "anna", "3.5", "km", "ten", "percent", "20kg", "5", "km"]
    assert [int(t) for t, s in zip(tokens, slots) if s] == [NAME, NAME, NUM, UNIT, NUM, UNIT, NUM, NUM, UNIT]
    assert row.tolist() == [0] * 10 + [1] * 4
    assert [(t, v) for t, _, v in template(text)] == [(int(t), s) for t, s, r in zip(tokens, slots, row) if r == 0]


def test_words_survive_when_their_memory_is_emptied(monkeypatch):
    import pennant.llm.decontaminate as d

    monkeypatch.setattr(d, "MEMORY_BYTES", 900)
    words, rng = Words(), random.Random(4)
    odd = (
        "Anna 12 km the Of 7.5 percent und É École ÉCOLE Über über STRAßE ß ÷ ×a a×b ÿ Ÿ Éa%% De%%% de,%% (Anna) \"Anna.\" Anna's x-y x- -x +x x+ _x x_ "
        "%% $5 5$ $x x$ … «Anna» Anna… End.') end!] 日本語 Ł ŁÓDŹ Łódź a.b ...a a... , . ; ;) :-) 3rd 20kg 5km/h A a I X. Ab: n° ° 5° é. É: Ça ça? Ñandú ñ² ª Àb".split()
    )
    for _ in range(60):
        text = " ".join(rng.choice(odd) for _ in range(60))
        raw = np.frombuffer(text.encode(), np.uint8)
        tokens, plains, *_ = templates(raw, np.asarray([0, len(raw)]), words)
        assert [(int(t), int(p)) for t, p in zip(tokens, plains)] == [(t, p) for t, p, _ in template(text)]


@pytest.fixture(scope="module")
def two_tongues():
    rng = random.Random(3)
    words = {"aa": "the and of thing over with".split(), "bb": "der und von sache über mit".split()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "e"]) for _ in range(n))
    return [(i, text(x := rng.choice(["aa", "bb"]), rng.randint(3, 120)), x) for i in range(300)]


def test_languages(spark, two_tongues):
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !!", "bb"), (903, two_tongues[0][1], None), (None, two_tongues[1][1], "aa"), (2, two_tongues[2][1], "bb"), (904, "the and " * 9000, "aa")]
    got = languages(docs_of(spark, two_tongues + odd)).collect()
    assert len(got) == len(two_tongues) + len(odd)
    truth = {i: x for i, _, x in two_tongues}
    held = [r for r in got if r.held_out and (r.doc_id or 0) < 300]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held) and len(held) > 50
    assert sum(truth.get(r.doc_id) == r.lang_pred for r in held if r.doc_id in truth) > 0.95 * sum(r.doc_id in truth for r in held)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (900, 901, 902)} == {i: ("und", 0.0) for i in (900, 901, 902)}
    assert languages(docs_of(spark, [])).count() == 0
    assert {r.lang_pred for r in languages(docs_of(spark, [(1, "abc", None)])).collect()} == {"und"}
    kept = keep_known(docs_of(spark, two_tongues + odd))
    assert kept.columns == SCHEMA.replace(",", "").split()[::2] and kept.count() == len(two_tongues) + len(odd) - 3


def test_quality(spark, two_tongues):
    rng = random.Random(4)
    bad = lambda n: " | ".join("".join(rng.choice("xyzqw!") for _ in range(5)) for _ in range(n))
    rows = [(i, bad(30) if i % 3 == 0 else t, x) for i, t, x in two_tongues] + [(None, None, None), (901, "", "aa"), (902, bad(20_000), "aa")]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame(
        [(i, int(i % 3 != 0), "x") for i in range(0, 300, 2)] + [(None, 1, "x"), (5000, 0, "x"), (4, None, "x"), (6, 0, "x")], "doc_id long, quality int, text string"
    )
    got = quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 2]
    assert sum(r.good == (r.doc_id % 3 != 0) for r in unseen) > 0.95 * len(unseen)
    assert quality(docs_of(spark, []), labels).count() == 0
    assert {r.good for r in quality(docs, labels.limit(0)).collect()} == {True}


def test_lm_is_normalised_and_learns_from_context():
    """Over all words of a small vocabulary and one unseen word of each kind, probabilities after any context sum to 1."""
    import pennant.llm.lm_score as lm

    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(400)]
    lines = [" ".join(rng.choice(words[:40] if i % 2 else words[200:]) for _ in range(30)) for i in range(200)]
    raw = np.frombuffer("".join(lines).encode(), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(x) for x in lines])])
    token, kind, first = lm.tokens(raw, at)
    distinct, one, n = np.unique(token, return_index=True, return_counts=True)

    order = sorted(zip((-n).tolist(), distinct.view(np.int64).tolist(), kind[one].tolist()))
    words_of = np.asarray([r[1] for r in order], np.int64).view(np.uint64)
    counts, kinds = np.asarray([-r[0] for r in order]), np.asarray([r[2] for r in order])
    place = np.flatnonzero(words_of != lm.END)
    classes = 1 + lm.TOP + kinds
    class_counts, class_types = np.zeros(lm.CLASSES), np.zeros(lm.CLASSES)
    classes[place[: lm.TOP]] = np.arange(1, lm.TOP + 1)
    classes[words_of == lm.END] = 0
    np.add.at(class_counts, classes, counts)
    np.add.at(class_types, classes, 1)
    by = np.argsort(words_of)
    contexts = np.arange(len(words_of))
    v = lm.Vocabulary(words_of[by], counts[by], classes[by], contexts[by], int(counts.sum()), len(counts), class_counts, class_types)
    trainer = lm.Trainer(lm.start_model(v), (class_counts + 0.5) / (class_counts + 0.5).sum(), rate=0.1)
    found, _, where = lm.look_up(v, token)
    y, c = lm.contexts(v, token, kind, first, where, found)
    for _ in range(10):
        for i in range(0, len(y), 512):
            trainer._batch(y[i : i + 512], c[:, i : i + 512])
    after = c[:, [3, 700, 2000]]
    total = np.zeros(3)
    share = np.zeros(lm.CLASSES)
    np.add.at(share, classes, np.where(classes > lm.TOP, (counts + 0.5), 1.0))
    share[lm.TOP + 1 :] += 0.5  # an unseen word
    share[lm.TOP + 1 :] /= class_counts[lm.TOP + 1 :] + 0.5 * (class_types[lm.TOP + 1 :] + 1)
    for k in range(lm.CLASSES):
        total += np.exp(lm.log_probabilities(trainer.m, np.full(3, k), after)) * share[k]
    assert np.allclose(total, 1, atol=1e-4)
    brute = [math.exp(sum((trainer.m.embed[after[j, 0]] * trainer.m.scale[j]).astype(float) for j in range(lm.CONTEXT)) @ trainer.m.out[k].astype(float) + trainer.m.bias[k]) for k in range(lm.CLASSES)]
    assert math.isclose(math.log(brute[5] / sum(brute)), lm.log_probabilities(trainer.m, np.asarray([5]), after[:, :1])[0], abs_tol=1e-4)
    prior = np.log(class_counts[y] / class_counts.sum())
    assert lm.log_probabilities(trainer.m, y, c).mean() > prior.mean() + 0.3


def test_lm_beats_the_base_on_held_out_text(spark):
    got = lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    n = sum(r.n_tokens for r in got)
    model, base = sum(r.score for r in got) / n, sum(r.base_score for r in got) / n
    print(f"held out, log10 a token: model {model:.3f}, base {base:.3f}")
    assert model > base + 0.1


def test_lm_scores(spark, two_tongues):
    rows = two_tongues + [(None, "the and", "aa"), (900, None, "aa"), (901, "", "aa"), (902, "never seen words only", None), (3, two_tongues[3][1], None), (903, "the und " * 9000, None)]
    got = lm_scores(docs_of(spark, rows)).collect()
    tokens = lambda t: [w for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())] + [None]
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 5
    counts = Counter(w for i, t, _ in rows if fold(i) not in (None, 1) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t, _ in rows:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))
        want[i, fold(i) == 1, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.held_out and (r.doc_id or 0) < 300]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)
    assert lm_scores(docs_of(spark, [])).count() == 0
    alone = lm_scores(docs_of(spark, [(None, "a b", None)])).collect()
    assert alone[0].n_known == 0 and alone[0].train_tokens == 0


def test_softmax_is_normalised():
    from pennant.llm import lm_score as lm

    hashes = np.sort(np.append(np.arange(1, 400, dtype=np.uint64) * np.uint64(7919), lm.END))
    counts = np.where(hashes == lm.END, 50, 3)
    v = lm.Vocabulary(hashes, counts, np.full(400, lm.OUT_WORDS + 1), np.full(400, lm.CONTEXT_WORDS), int(counts.sum()), 400, np.ones(lm.OUT_WORDS + 2))
    m = lm.start_model(v)
    c = np.full((lm.CONTEXT, lm.OUT_WORDS + 2), 5, np.uint16)
    assert math.isclose(np.exp(lm.log_probabilities(m, np.arange(lm.OUT_WORDS + 2), c)).sum(), 1.0, rel_tol=1e-4)


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "allow"


def test_url_verdicts(spark):
    urls = [
        "http://example.com/en/1", "https://WWW.Example.com/en/x?y#z", "http://m.www.example.com/en/", "http://example.com", "http://com/", "http://notexample.com/en/",
        "x://a.net/es/1", "x://net/fr/", "x://net/fr", "x://a.net/ES/", None, "", "no scheme", "http://", "a://b://net/es/", "http://net?/es/", "http://a\nb.net/fr/\n?q",
        "http://É.net/es/é", "http://.com/", "http://com./", "http://example.com:80/en/",
    ]
    rows = [(i, u, "h", "p") for i, u in enumerate(urls)] + [(None, urls[0], "h", "p"), (0, urls[0], "h", "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, key string")
    got = url_verdicts(pages, rule_table(spark, URL_RULES)).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *brute_url(u)) for i, u, *_ in rows)
    assert url_verdicts(pages.limit(0), rule_table(spark, URL_RULES)).count() == 0
    assert {r.verdict for r in url_verdicts(pages, rule_table(spark, []) if False else rule_table(spark, URL_RULES).limit(0)).collect()} == {"allow"}


def test_min_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 9)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        joins = [(a, b, rng.uniform(0, 3)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4]
        cost = lambda x: sum(abs(o) for o, k in zip(odds, x) if k != (o > 0)) + sum(w for a, b, w in joins if x[a] != x[b])
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert math.isclose(cost(min_cut(odds, joins)), best, abs_tol=1e-9)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="has-sidebar">
<header><a href="/">Site name</a></header><nav><ul><li><a href="/a">Menu one</a></li></ul></nav><div class="cookie-notice">We use cookies on all of these pages, friend.</div>
<article><h1>Title &amp; more</h1><p>First   paragraph<br>goes on &eacute;<!-- no --> and <b>on</b>.<p>Unclosed second, long enough to read.
<div class="ad">Buy this, it is cheap and good for you and yours.</div><p>a &lt; b and 3 < 4</p><form><p>Sign up here please</p></form>
<section id="comments"><p>I liked reading this very much, thank you all.</p></section></article>
<aside><p>Other stories that you may like to read today.</p></aside><footer>&copy; us</footer></body></html>"""


def test_html_extract(spark):
    assert main_text(PAGE) == "Title & more\nFirst paragraph goes on é and on.\nUnclosed second, long enough to read.\na < b and 3 < 4"
    assert main_text(None) == main_text("") == main_text("<nav>only a menu</nav>") == ""
    rows = [(1, "u", PAGE, 0), (1, "u", PAGE, 0), (None, None, None, 0), (2, "v", "", 0), (3, "w", "<article><p>" + "word " * 50_000 + "</p>", 0)]
    ship_code(spark)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = Counter((r.page_id, r.url, r.n_chars, len(r.text)) for r in extract(pages).collect())
    n = len(main_text(PAGE))
    assert got == Counter({(1, "u", n, n): 2, (None, None, 0, 0): 1, (2, "v", 0, 0): 1, (3, "w", 249_999, 249_999): 1})
    assert extract(pages.limit(0)).count() == 0


def test_min_cut_of_long_undecided_rows_is_quick():
    rng = random.Random(6)
    n = 20_000
    odds = [rng.uniform(-0.6, 0.6) for _ in range(n)]
    joins = [(i, i + 1, 0.5) for i in range(n - 1)] + [(i, i + 2, 0.7) for i in range(0, n - 2)]
    began = time.process_time()
    keep = min_cut(odds, joins)
    assert time.process_time() - began < 60 and 0 < sum(keep) < n


MENU = '<nav><a href="/">Home</a><a href="/x">More</a></nav>'
STORY = "<h1>A long story</h1><p>It began in the morning, and nobody knew why.</p><p>Short.</p><p>Then, as the sun went down, all of it ended well.</p>"
LINES = "A long story\nIt began in the morning, and nobody knew why.\nShort.\nThen, as the sun went down, all of it ended well."


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="has-sidebar">{MENU}<article>{STORY}</article><div class="sidebar"><p>Other things you could read as well.</p></div></div>',
        f'<form>{MENU}<article>{STORY}</article><footer>All rights reserved by someone.</footer></form>',
        f'<div class="with-header"><div class="menu"><a href="/">Home</a></div><div>{STORY}</div><div class="footer">Nobody may copy any of this.</div></div>',
        f'{MENU}<article>{STORY.replace("<h1>", "<div class=post-header><h1>").replace("</h1>", "</h1></div>")}</article>',
        f'{MENU}<article>{STORY.replace("<p>Then", "<p title=\'a hidden door\' data-id=menu>Then")}</article>',
        f'{MENU}<main>{STORY}</main><section id="comments"><article class="comment"><p>I liked this one very much, thank you all.</p></article></section>',
        f'{MENU}<article>{STORY}<div class="share"><a href="/s">Share this</a></div><p hidden>You cannot see this, so it is not there.</p></article>',
        f'<div class="ad">Buy one of these now, they are cheap.</div><article>{STORY}</article><div class="cookie-notice">We use cookies. You may say no.</div>',
        f'<article>{STORY.replace("Short.", "Short.<!-- x --><script>var a = 1;</script><style>p{{}}</style>")}</article><aside>See also our other fine stories.</aside>',
    ],
)
def test_frames_forms_and_attributes(page):
    assert main_text(page) == LINES


def test_white_space_is_ascii_white_space():
    assert main_text("<article><p>one\t\n two\x0b&#9;three&nbsp;four\x1cfive\u2003six  </p></article>") == "one two three\u00a0four\x1cfive\u2003six"


def test_deep_and_unclosed_pages_are_linear():
    for page in ("<div>" * 100_000 + "<p>Down here, at last, is a sentence.</p>", "".join(f"<div><p>Sentence number {i} is here.</p>" for i in range(20_000)), "<p>x</div>" * 100_000, "</div>" * 100_000):
        began = time.process_time()
        parse(page)
        main_text(page)
        assert time.process_time() - began < 20


def test_pages_of_the_test_tables(spark):
    """Each page's article, taken out by its tags."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    ship_code(spark)
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id] == "\n".join(p for p in parts if p)


def plain_page(page):
    """The same page without anything that says what its parts are."""
    page = re.sub(r"<(/?)(?:article|nav|footer|main|aside|header)[^>]*>", r"<\1div>", page)
    return re.sub(r' class="[^"]*"', "", page)


@pytest.mark.parametrize("tags", [True, False])
def test_the_cut_where_pages_say_nothing(spark, tags):
    """Blocks of the test pages without landmarks: the fitted classifier alone, and after the cut; also if it sees text only."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    weights = fit(pages[:100])
    assert not np.allclose(weights, PRIOR)
    if not tags:
        weights[[FEATURES.index(f) for f in ("paragraph", "heading", "list_item", "division")]] = 0.0
        weights[0] = -1.0
    wrong = wrong_cut = changed = n = 0
    for page in pages[100:]:
        said, _, truth = labels(page, weights)
        row, odds, keep = labels(plain_page(page), weights)
        assert ["".join(b.text) for b in row] == ["".join(b.text) for b in said]
        alone = (odds > 0).tolist()
        n += len(row)
        changed += sum(a != k for a, k in zip(alone, keep))
        wrong += sum(a != t for a, t in zip(alone, truth))
        wrong_cut += sum(k != t for k, t in zip(keep, truth))
    print(f"of {n} labels the cut changes {changed}; wrong {wrong} before, {wrong_cut} after")
    if tags:
        assert wrong_cut < 0.05 * n
    else:
        assert changed > 0.1 * n and wrong_cut < 0.75 * wrong


def test_url_filter_grows_with_its_list(spark):
    from pennant.llm import url_filter as u

    assert [u.blocks_for(n) for n in (0, 5, 4096, 4097, 1_000_000)] == [1024, 1024, 1024, 2048, 1 << 18]
    rules = spark.range(20_000).selectExpr("'block' AS verdict", "concat('h', id, '.org') AS host", "'/' AS path")
    pages = spark.range(30_000).selectExpr("id AS page_id", "concat('http://www.h', id, '.org/x') AS url")
    got = u.url_verdicts(pages, rules)
    assert got.where("verdict = 'block'").count() == 20_000 and got.where("rule IS NULL").count() == 10_000
    blocks = u.blocks_for(20_000)
    listed = rules.selectExpr("concat_ws('\\0', host, path) AS key")
    full = u.bloom(listed, blocks).selectExpr("sum(bit_count(bits)) AS n").first().n
    assert full < 0.4 * 64 * blocks

"""Language identification by a byte convolutional network.

Embedded bytes, filters of several widths, a maximum over each fixed-length window, softmax. The whole text is cut
into windows; its prediction is the mean of their log-probabilities. Trained with numpy on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import remainder
from pennant.llm.words import chunks

WINDOW = 192  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 12  # per width
EMBED = 8
SPAN = max(WIDTHS)


@dataclass
class ByteCNN:
    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    kernel: np.ndarray  # SPAN * EMBED x filters; a filter of smaller width has zero rows at its end
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def windows(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, row of each): every text in pieces of WINDOW bytes, the last one padded with zeros."""
    sizes = np.diff(at)
    per = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), per)
    first = np.cumsum(per) - per
    starts = at[row] + (np.arange(len(row)) - first[row]) * WINDOW
    place = starts[:, None] + np.arange(WINDOW)
    inside = place < at[row + 1][:, None]
    return np.where(inside, raw[np.minimum(place, max(len(raw) - 1, 0))], 0).astype(np.uint8) if len(raw) else np.zeros((0, WINDOW), np.uint8), row


def _columns(net: ByteCNN, x: np.ndarray) -> np.ndarray:
    """(windows, places, SPAN * EMBED) inputs of the filters."""
    e = net.embed[x]
    return np.lib.stride_tricks.sliding_window_view(e.reshape(len(x), -1), SPAN * EMBED, axis=1)[:, ::EMBED]


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def predict(net: ByteCNN, x: np.ndarray, block: int = 256) -> np.ndarray:
    """Log-probabilities per window."""
    out = np.empty((len(x), len(net.langs)), np.float32)
    for i in range(0, len(x), block):
        part = x[i : i + block]
        cols = np.ascontiguousarray(_columns(net, part)).reshape(-1, SPAN * EMBED)
        best = (cols @ net.kernel).reshape(len(part), -1, net.kernel.shape[1]).max(1)
        out[i : i + block] = _log_softmax(np.maximum(best + net.bias, 0) @ net.out + net.out_bias)
    return out


def train(texts: list[bytes], langs: list[str], epochs: int = 12, per_text: int = 8, batch: int = 64, seed: int = 7) -> ByteCNN:
    """Fit on at most ``per_text`` windows of each text, spread over it; Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    data, row = windows(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
    pick = np.concatenate([[0]] + [np.unique(np.linspace(a, b - 1, min(per_text, b - a)).astype(int)) for a, b in _runs(row)])[1:].astype(int)
    data, label = data[pick], np.asarray([names.index(x) for x in langs])[row[pick]]
    n = len(WIDTHS) * FILTERS
    mask = np.concatenate([np.repeat([w > k for w in WIDTHS], FILTERS)[None].repeat(EMBED, 0) for k in range(SPAN)]).astype(np.float32)
    net = ByteCNN(
        names, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), rng.normal(0, 0.3, (SPAN * EMBED, n)).astype(np.float32) * mask,
        np.zeros(n, np.float32), rng.normal(0, 0.1, (n, len(names))).astype(np.float32), np.zeros(len(names), np.float32),
    )
    if not len(data):
        return net
    params = [net.embed, net.kernel, net.bias, net.out, net.out_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    share = np.bincount(label, minlength=len(names))
    weight = (len(label) / (len(names) * np.maximum(share, 1))).astype(np.float32)
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        for i in range(0, len(order), batch):
            x, y = data[order[i : i + batch]], label[order[i : i + batch]]
            cols = np.ascontiguousarray(_columns(net, x))
            z = cols @ net.kernel
            arg = z.argmax(1)
            hidden = np.maximum(np.take_along_axis(z, arg[:, None], 1)[:, 0] + net.bias, 0)
            prob = np.exp(_log_softmax(hidden @ net.out + net.out_bias))
            prob[np.arange(len(y)), y] -= 1
            prob *= weight[y][:, None] / len(y)
            back = (prob @ net.out.T) * (hidden > 0)
            best = cols[np.arange(len(x))[:, None], arg]  # (batch, filters, SPAN * EMBED): only the winning places learn
            d_kernel = np.einsum("bf,bfk->kf", back, best) * mask
            d_cols = back[:, :, None] * net.kernel.T[None]
            d_embed = np.zeros_like(net.embed)
            for k in range(SPAN):
                np.add.at(d_embed, x[np.arange(len(x))[:, None], arg + k], d_cols[:, :, k * EMBED : (k + 1) * EMBED])
            step += 1
            rate = 0.01 * (1 - epoch / epochs)
            for p, (m, v), g in zip(params, moments, (d_embed, d_kernel, back.sum(0), hidden.T @ prob, prob.sum(0))):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _runs(row: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.diff(row)) + 1
    edges = [0, *cut.tolist(), len(row)]
    return [(a, b) for a, b in zip(edges[:-1], edges[1:]) if b > a]


def training_rows(docs: DataFrame, per_lang: int, id_col: str, text_col: str, lang_col: str, fold: int = 4, held: int = 2) -> DataFrame:
    """(lang, text): for each language about ``per_lang`` documents, chosen by the hash of id and text, outside the held-out
    fold. An id that very many rows share is chosen text by text."""
    usable = docs.where((remainder(F.col(id_col), fold) != held) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    sizes = usable.groupBy(F.col(lang_col).alias("lang")).count().collect()  # a row per language
    share = F.coalesce(*(F.when(F.col(lang_col) == r.lang, F.lit(min(1.0, per_lang / r["count"]))) for r in sizes), F.lit(0.0))
    unit = F.pmod(F.xxhash64(id_col, text_col, F.lit(11)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return usable.where(unit < share).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def fit(docs: DataFrame, per_lang: int = 400, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_bytes: int = 4000) -> ByteCNN:
    """Train on about ``per_lang`` documents of each language (a bounded sample by hash, equal texts once) and at most
    ``most_bytes`` from the middle of each; predictions read whole texts."""
    rows = training_rows(docs, per_lang, id_col, text_col, lang_col)
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - most_bytes) / 2)).cast("int")
    slim = rows.select("lang", F.substring(F.col("text"), middle, F.lit(most_bytes)).alias("text")).distinct()  # copies are one
    got = sorted((r.lang, r.text) for r in slim.collect())
    return train([t.encode() for _, t in got], [x for x, _ in got])


def with_language(docs: DataFrame, net: ByteCNN, text_col: str = "text") -> DataFrame:
    """(whole, lang_pred, score) per row; ``whole`` holds the row itself.

    Null texts, texts without a letter and every text where no language was learned get ``und`` and 0.0. Ties go to
    the first language in alphabetical order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in batches:
            text = b.column("text")
            best, sure = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for start, end, raw, at in chunks(text, 1 << 20):
                if not net.langs:
                    break
                x, row = windows(raw, at)
                total = np.zeros((end - start, len(net.langs)))
                count = np.bincount(row, minlength=end - start)
                logs = predict(net, x)
                for k in range(len(net.langs)):
                    total[:, k] = np.bincount(row, weights=logs[:, k], minlength=end - start)
                p = np.exp(_log_softmax(total / np.maximum(count, 1)[:, None]))
                best[start:end], sure[start:end] = p.argmax(1), p.max(1)
            ok = b.column("letter").to_numpy(zero_copy_only=False).astype(bool) & bool(net.langs)
            names = np.asarray([*net.langs, "und"], object)
            lang = pa.array(names[np.where(ok, best, len(net.langs))], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("whole"), lang, pa.array(np.where(ok, sure, 0.0))], ["whole", "lang_pred", "score"])

    base = docs.select(
        F.struct("*").alias("whole"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letter")
    )
    schema = base.select("whole", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return base.mapInArrow(judge, schema)


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 400) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row; a null id counts as not held out and is not learned from."""
    net = fit(docs, per_lang, id_col, text_col, lang_col)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = F.coalesce(remainder(F.col("whole.doc_id"), 4) == 2, F.lit(False))
    return with_language(slim, net).select(F.col("whole.doc_id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = 0.3) -> DataFrame:
    """Rows whose language is recognised; ``und`` and scores under ``min_score`` are rejected."""
    net = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    return with_language(docs, net, text_col).where((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select("whole.*")

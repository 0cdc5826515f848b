"""Quality classifier by co-training: a text-content view and a page-metadata view.

Each round every view labels the unlabelled documents it is surest of for the other view. Both are then calibrated
on labelled documents kept aside, and the calibrated views are combined for every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.words import chunks, hashed, mix, spans

WORD_DIMS, META_DIMS = 512, 96
LABELLED, POOL = 6000, 6000  # bound of the sample that is fitted on
ROUNDS, PER_ROUND = 4, 300

# Byte classes of the text view: upper, lower, digit, punctuation, space, line break, beyond ASCII.
_CLASS = np.full(256, 3)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10], _CLASS[128:] = 4, 5, 6
SHAPE = 14
TEXT_DIMS = SHAPE + WORD_DIMS


def shape_features(raw: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, word: np.ndarray) -> np.ndarray:
    n = len(at) - 1
    out = np.zeros((n, SHAPE), np.float32)
    if not len(raw):
        return out
    text = np.repeat(np.arange(n), np.diff(at))
    size = np.maximum(np.diff(at), 1)
    kinds = np.bincount(text * 7 + _CLASS[raw], minlength=7 * n).reshape(n, 7) / size[:, None]
    words = np.maximum(np.bincount(row, minlength=n), 1)
    closes = (_CLASS[raw[np.maximum(ends - 1, 0)]] == 3).astype(np.float64)
    shouts = (_CLASS[raw[starts]] == 0) & (_CLASS[raw[np.maximum(ends - 2, starts)]] == 0) & (ends - starts > 2)
    lone = (_CLASS[raw[starts]] == 3).astype(np.float64)
    keys = np.unique(row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ word, return_index=True)[1]
    out[:, :7] = kinds * 4
    out[:, 7] = np.log1p(np.diff(at)) / 5
    out[:, 8] = np.bincount(row, weights=ends - starts, minlength=n) / words / 5
    out[:, 9] = np.bincount(row, weights=closes, minlength=n) / words * 2
    out[:, 10] = np.bincount(row, weights=shouts, minlength=n) / words * 2
    out[:, 11] = np.bincount(row, weights=lone, minlength=n) / words * 2
    out[:, 12] = np.bincount(row[keys], minlength=n) / words
    out[:, 13] = words / (1 + np.bincount(text, weights=raw == 10, minlength=n)) / 50
    return out


def text_view(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, features) of whole texts."""
    for start, end, raw, at in chunks(column, 1 << 20):
        s, e, row = spans(raw, at)
        word = hashed(raw, s, e)
        n = end - start
        bucket = (word >> np.uint64(20)).astype(np.int64) % WORD_DIMS
        counts = np.bincount(row * WORD_DIMS + bucket, minlength=n * WORD_DIMS).reshape(n, WORD_DIMS)
        share = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
        yield start, end, np.concatenate([shape_features(raw, at, s, e, row, word), share], axis=1).astype(np.float32)


def _bucket(value: str, kind: int) -> int:
    h = np.frombuffer(value.encode()[:64].ljust(64, b"\0"), np.uint64)
    return int(mix(np.asarray([mix(h).sum(dtype=np.uint64) + np.uint64(kind)], np.uint64))[0] % np.uint64(60))


def meta_view(source: list, lang: list, n_chars: list) -> np.ndarray:
    """Source and language by hashed bucket, length by step of powers of two; null is a value of its own."""
    out = np.zeros((len(source), META_DIMS), np.float32)
    for i, (s, x, n) in enumerate(zip(source, lang, n_chars)):
        out[i, _bucket(s if s is not None else "\0none", 1)] += 1
        out[i, _bucket(x if x is not None else "\0none", 2)] += 1
        out[i, 60 + (35 if n is None or n < 0 else min(34, int(n).bit_length()))] = 1
    return out


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 200, l2: float = 1e-4, rate: float = 0.1) -> Linear:
    """Logistic regression with classes of equal weight; Adam on the full sample."""
    w = np.zeros(x.shape[1] + 1, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max(len(y) - y.sum(), 1)).astype(np.float32)
    for t in range(1, steps + 1):
        z = np.clip(x @ w[:-1] + w[-1], -30, 30)
        g = (1 / (1 + np.exp(-z)) - y) * weight
        grad = np.append(x.T @ g + l2 * w[:-1], g.sum()).astype(np.float32)
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Linear(w[:-1].copy(), float(w[-1]))


@dataclass
class CoTrained:
    text: Linear
    meta: Linear
    scales: tuple[tuple[float, float], tuple[float, float]]  # calibrated logit = a * logit + b
    mix: tuple[float, float, float]  # weights of the calibrated views, and bias

    def scores(self, x_text: np.ndarray, x_meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, metadata, combined) probabilities of good quality."""
        (a, b), (c, d) = self.scales
        zt, zm = np.clip(a * self.text.logit(x_text) + b, -30, 30), np.clip(c * self.meta.logit(x_meta) + d, -30, 30)
        z = np.clip(self.mix[0] * zt + self.mix[1] * zm + self.mix[2], -30, 30)
        return tuple(1 / (1 + np.exp(-v.astype(np.float64))) for v in (zt, zm, z))


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's scaling, the classes in their own proportions."""
    a, b = 1.0, 0.0
    for _ in range(300):
        g = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))) - y
        a, b = a - 0.5 * float((g * z).mean()) / (1 + float((z * z).mean())), b - 0.5 * float(g.mean())
    return max(a, 0.0), b


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, seed: int = 3) -> CoTrained:
    rng = np.random.default_rng(seed)
    aside = rng.random(len(y)) < 0.25
    base = float(y.mean()) if len(y) else 0.5
    if len(set(y[~aside].tolist())) < 2 or len(set(y[aside].tolist())) < 2:  # one class alone: its share is the score
        flat = float(np.log((base + 1e-3) / (1 - base + 1e-3)))
        return CoTrained(Linear(np.zeros(text.shape[1], np.float32), 0.0), Linear(np.zeros(meta.shape[1], np.float32), 0.0), ((1.0, flat), (1.0, flat)), (0.5, 0.5, 0.0))
    views = [[text[~aside], y[~aside]], [meta[~aside], y[~aside]]]
    pools, free = [pool_text, pool_meta], np.ones(len(pool_text), bool)
    for _ in range(ROUNDS):
        models = [fit_linear(x, t) for x, t in views]
        for k in (0, 1):
            left = np.flatnonzero(free)
            if not len(left):
                break
            z = models[k].logit(pools[k][left])
            order = np.argsort(z)
            low, high = order[: int(PER_ROUND * (1 - base))], order[::-1][: int(PER_ROUND * base)]
            low, high = left[low[z[low] < 0]], left[high[z[high] > 0]]
            picked = np.concatenate([low, high])
            other = views[1 - k]
            other[0] = np.concatenate([other[0], pools[1 - k][picked]])
            other[1] = np.concatenate([other[1], np.repeat([0.0, 1.0], [len(low), len(high)])])
            free[picked] = False
    models = [fit_linear(x, t) for x, t in views]
    scales = tuple(_calibrate(m.logit(x[aside]), y[aside]) for m, x in zip(models, (text, meta)))
    z = [a * m.logit(x[aside]) + b for m, x, (a, b) in zip(models, (text, meta), scales)]
    rank = [max(0.0, abs(float(np.corrcoef(v, y[aside])[0, 1]))) if v.std() > 0 else 0.0 for v in z]
    total = sum(r * r for r in rank) or 1.0
    weights = [r * r / total for r in rank]  # a view counts as much as it explains
    a, b = _calibrate(weights[0] * z[0] + weights[1] * z[1], y[aside])
    return CoTrained(models[0], models[1], scales, (a * weights[0], a * weights[1], b))


def _unit(col: str, salt: int) -> Column:
    return F.pmod(F.xxhash64(col, F.lit(salt)), F.lit(1 << 20)) / F.lit(float(1 << 20))


def fit(docs: DataFrame, labels: DataFrame) -> CoTrained:
    """Fit on about LABELLED labelled and POOL unlabelled documents, chosen by id hash.

    ``docs``: (doc_id, text, source, lang, n_chars). ``labels``: (doc_id, quality); several labels of a document are
    averaged and rounded up from a half, null ids and labels are left out.
    """
    given = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    n_labels, n_docs = max(given.count(), 1), max(docs.count(), 1)
    known = given.where(_unit("doc_id", 5) < LABELLED / n_labels).toArrow()  # bounded
    marks = dict(zip(known.column("doc_id").to_pylist(), known.column("y").to_pylist()))
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, unit = b.column("doc_id").to_pylist(), b.column("unit").to_pylist()
            y = [shared.value.get(i) for i in ids]
            pick = pa.array([i for i, v in enumerate(y) if v is not None or (unit[i] is not None and unit[i] < POOL / n_docs)], pa.int64())
            part = b.take(pick)
            meta = meta_view(*(part.column(c).to_pylist() for c in ("source", "lang", "n_chars")))
            for start, end, x in text_view(part.column("text")):
                rows = np.concatenate([x, meta[start:end]], axis=1)
                marks = [y[i] for i in pick.to_pylist()[start:end]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(start, end - start), pa.array(marks, pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "y", "x"]
                )

    unit = F.pmod(F.xxhash64("doc_id", "text", F.lit(6)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    picked = docs.withColumn("unit", unit).mapInArrow(features, "doc_id long, y int, x binary")
    got = picked.select("y", "x").distinct().toArrow()  # copies are one, and an id that many rows share is picked text by text
    rows = got.column("x").to_pylist()
    order = sorted(range(len(rows)), key=rows.__getitem__)  # whatever order the tasks ended in
    x = np.frombuffer(b"".join(rows), np.float32).reshape(-1, TEXT_DIMS + META_DIMS)[order]
    y = np.asarray([np.nan if v is None else v for v in got.column("y").to_pylist()])[order]
    has = ~np.isnan(y)
    return co_train(x[has, :TEXT_DIMS], x[has, TEXT_DIMS:], y[has], x[~has, :TEXT_DIMS], x[~has, TEXT_DIMS:])


SCORES = "doc_id long, text_score double, meta_score double, score double, good boolean"


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_score, meta_score, score, good (score of a half or more) per row of ``docs``.

    Null texts and metadata are values like others. Without labels every score is a half; with one class alone it is
    near that class. Labels of unknown documents have no effect; other columns are not read.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"))
    model = fit(base, labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality")))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            meta = meta_view(*(b.column(c).to_pylist() for c in ("source", "lang", "n_chars")))
            for start, end, x in text_view(b.column("text")):
                t, m, both = shared.value.scores(x, meta[start:end])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(start, end - start), pa.array(t), pa.array(m), pa.array(both), pa.array(both >= 0.5)],
                    ["doc_id", "text_score", "meta_score", "score", "good"],
                )

    return base.mapInArrow(judge, SCORES)

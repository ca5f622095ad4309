"""Hashed word and character n-gram logistic regression.

Features of a text, in four families with ``DIM`` slots each: words, word
pairs (a repeated word is one feature), 3 bytes and 5 bytes, as shares of the
family's n-grams.  A model is
one weight per slot, so scoring is a gather and a sum over positions: no
per-document dictionary, memory follows the chunk.  It is fitted on the
driver from a sample, bounded in rows and in bytes of text (``SAMPLE_BYTES``),
whose features are made in Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm.stages import written
from civicflow.llm.textmap import NOT_SPACE, Chunk, Words, drawn, emit_rows, mix, quoted, windows

DIM = 1 << 15
FAMILIES = 4
# shares are small numbers; scaled so that a step moves the score
SCALE = 20.0
# rows of the sample in one product
BLOCK = 100
# bytes of text that a model is fitted on, about: the driver holds their features, some 30 bytes for each byte
SAMPLE_BYTES = 12 << 20


def slots(chunk: Chunk, words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family the slot of each n-gram and the row it belongs to."""
    h = words.hashes()
    at, pair = windows(h, words.row, 2)
    # a word twice in a row is one feature, whatever the word
    twice = h[at] == h[at + 1] if len(at) else np.zeros(0, bool)
    out = [((h & np.uint64(DIM - 1)).astype(np.int32), words.row),
           (np.where(twice, 0, (pair & np.uint64(DIM - 1)).astype(np.int32)), words.row[at])]
    n = len(chunk.data)
    row_of = np.repeat(np.arange(chunk.n), np.diff(chunk.off))
    wide = chunk.data.astype(np.uint64)
    for k in (3, 5):
        m = n - k + 1
        if m <= 0:
            out.append((np.zeros(0, np.int32), np.zeros(0, np.int64)))
            continue
        packed = wide[:m].copy()
        for j in range(1, k):
            packed |= wide[j:m + j] << np.uint64(8 * j)
        inside = row_of[:m] == row_of[k - 1:]
        out.append(((mix(packed[inside] + np.uint64(k)) & np.uint64(DIM - 1)).astype(np.int32), row_of[:m][inside]))
    return out


@dataclass
class Model:
    """Weights per family and slot, intercept, and the calibration p = 1 / (1 + exp(-(a * score + b)))."""

    weights: np.ndarray
    bias: float
    a: float = 1.0
    b: float = 0.0

    def raw(self, chunk: Chunk, words: Words) -> np.ndarray:
        score = np.full(chunk.n, self.bias)
        for w, (slot, row) in zip(self.weights, slots(chunk, words)):
            total = np.bincount(row, minlength=chunk.n)
            score += SCALE * np.bincount(row, weights=w[slot], minlength=chunk.n) / np.maximum(total, 1)
        return score

    def probability(self, chunk: Chunk, words: Words) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * self.raw(chunk, words) + self.b, -30, 30)))


def bounded(sample: DataFrame, text: str, most: int = SAMPLE_BYTES) -> DataFrame:
    """A sample of at most about ``most`` bytes of text: longer samples are thinned by a hash of the text.

    Texts of more than a sixteenth of that are not used.
    """
    size = F.octet_length(quoted(text)).cast("long")
    held = written(sample, "sample").filter(F.coalesce(size, F.lit(0)) <= most // 16)
    total = held.agg(F.sum(size)).first()[0] or 0
    return held.filter(drawn(F.xxhash64(quoted(text), F.lit(17)), most / total)) if total > most else held


def features(sample: DataFrame, text: str, target: str, fold: str) -> list:
    """Rows (target, fold, slots, shares) of a bounded sample; slots and shares are packed arrays."""
    schema = T.StructType([T.StructField("target", T.DoubleType()), T.StructField("fold", T.LongType()),
                           T.StructField("slots", T.BinaryType()), T.StructField("shares", T.BinaryType())])

    def run(chunk: Chunk, batch: pa.RecordBatch) -> list:
        words = Words(chunk.data, chunk.off, NOT_SPACE)
        per: list[list] = [[] for _ in range(chunk.n)]
        for f, (slot, row) in enumerate(slots(chunk, words)):
            key, count = np.unique(row.astype(np.int64) * DIM + slot, return_counts=True)
            owner = key // DIM
            total = np.bincount(row, minlength=chunk.n)
            share = (SCALE * count / total[owner]).astype(np.float32)
            cut = np.searchsorted(owner, np.arange(chunk.n + 1))
            for r in range(chunk.n):
                part = slice(cut[r], cut[r + 1])
                per[r].append(((key[part] % DIM + f * DIM).astype(np.int32), share[part]))
        ids = [np.concatenate([x[0] for x in p]).tobytes() for p in per]
        shares = [np.concatenate([x[1] for x in p]).tobytes() for p in per]
        return [batch.column(1).cast(pa.float64()), batch.column(2).cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())]

    return emit_rows(bounded(sample, text), text, [target, fold], schema, run).collect()


def fit(rows: list, steps: int = 120, rate: float = 0.2, l2: float = 1e-4) -> Model:
    """Weighted logistic loss by Adam steps over the whole sample; one fold in four calibrates (Platt).

    ``target`` may be a probability (soft labels).  Both classes weigh the
    same.  Without rows, or with one class only, the model says its rate.
    """
    rows = sorted(rows, key=lambda r: (r["fold"], r["target"], r["slots"]))
    y = np.array([r["target"] for r in rows])
    if not len(y) or y.max() < 0.5 or y.min() >= 0.5:
        p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        return Model(np.zeros((FAMILIES, DIM), np.float32), 0.0, 0.0, float(np.log(p / (1 - p))))
    held = np.array([r["fold"] % 4 == 3 for r in rows])
    if len({v >= 0.5 for v in y[held]}) < 2 or len({v >= 0.5 for v in y[~held]}) < 2:
        held = np.zeros(len(y), bool)
    # a block of rows at a time: the sample is held once, the products of one block besides
    blocks = []
    for lo in range(0, len(rows), BLOCK):
        part = rows[lo:lo + BLOCK]
        ids = [np.frombuffer(r["slots"], np.int32) for r in part]
        blocks.append((slice(lo, lo + len(part)), np.concatenate(ids), np.concatenate([np.frombuffer(r["shares"], np.float32) for r in part]),
                       np.repeat(np.arange(len(part), dtype=np.int32), [len(i) for i in ids])))
    del rows, part, ids

    def scores(w: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.concatenate([np.bincount(owner, weights=w[flat] * value, minlength=at.stop - at.start)
                                      for at, flat, value, owner in blocks])

    train = ~held
    share_good = y[train].mean()
    weight = np.where(train, y / (2 * share_good) + (1 - y) / (2 * (1 - share_good)), 0.0)
    weight /= weight.sum()
    dim = FAMILIES * DIM
    w, bias = np.zeros(dim), 0.0
    m, v, mb, vb = np.zeros(dim), np.zeros(dim), 0.0, 0.0
    for t in range(1, steps + 1):
        z = scores(w, bias)
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = l2 * w
        for at, flat, value, owner in blocks:
            grad += np.bincount(flat, weights=g[at][owner] * value, minlength=dim)
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.99 ** t
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-6) * (grad != 0)
        bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-6)
    z = scores(w, bias)
    a, b = platt(z[held], y[held]) if held.any() else (1.0, 0.0)
    return Model(w.reshape(FAMILIES, DIM).astype(np.float32), float(bias), a, b)


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for p = sigmoid(a z + b) with smoothed targets; the slope stays positive."""
    good, bad = y.sum(), (1 - y).sum()
    t = y * (good + 1) / (good + 2) + (1 - y) / (bad + 2)
    spread = max(float(np.std(z)), 1e-6)
    x = np.stack([z / spread, np.ones_like(z)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta -= np.clip(np.linalg.solve(h, x.T @ (p - t) + 1e-3 * theta), -2, 2)
    return max(float(theta[0]), 1e-3) / spread, float(theta[1])

"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on every document.  The
counts of all vote patterns (at most 3**10, whatever the size of the table)
are enough for expectation-maximisation to estimate each labeller's accuracy
and each pattern's posterior.  A bounded sample of documents with their
posteriors, drawn from the distinct texts so that copies neither crowd nor
thin it, then trains the hashed linear scorer of ``linear``, which scores all
documents.  No labels are used.

Cases: a null or empty text gets no vote but the length one, and scores by
its (missing) features; repeated rows score alike; an empty table gives no
rows and trains nothing; input columns with the names of result columns are
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm.linear import Model, features, fit
from civicflow.llm.quality_rules import base_counts
from civicflow.llm.stages import shared
from civicflow.llm.textmap import NOT_SPACE, Chunk, Words, drawn, map_text, quoted, per_row

LABELLERS = ("length", "symbols", "repeats", "capitals", "word_length", "letters", "variety", "stutter", "bare", "marked")
GOOD, NONE, BAD = 2, 1, 0
KEEP_PROBABILITY = 0.5
# most bad votes of one labeller among good documents, least among bad ones
SPECIFIC = (0.01, 0.3)
# bytes of letters, digits and all beyond ASCII; and of marks
_TEXT = np.zeros(256, bool)
_TEXT[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(0x21, 0x7F) if not _TEXT[b]]] = True
# documents that the scorer is fitted on, at most
SAMPLE = 2500


def votes(chunk: Chunk, words: Words) -> np.ndarray:
    """(rows, labellers) of BAD, NONE or GOOD."""
    c = base_counts(chunk, words)
    n = np.maximum(c["n_words"], 1)
    chars = np.maximum(c["word_chars"], 1)
    upper = per_row((chunk.data >= 0x41) & (chunk.data <= 0x5A), chunk.off)
    lower = per_row((chunk.data >= 0x61) & (chunk.data <= 0x7A), chunk.off)
    beyond = per_row(chunk.data >= 0xC0, chunk.off)
    h = words.hashes()
    order = np.lexsort((h, words.row))
    new = np.ones(len(h), bool)
    if len(h):
        new[1:] = (h[order][1:] != h[order][:-1]) | (words.row[order][1:] != words.row[order][:-1])
    distinct = np.bincount(words.row[order][new], minlength=chunk.n)
    out = np.full((chunk.n, len(LABELLERS)), NONE, np.int64)

    def vote(k: int, good: np.ndarray, bad: np.ndarray) -> None:
        out[good, k] = GOOD
        out[bad, k] = BAD

    vote(0, c["n_words"] >= 50, c["n_words"] < 2)
    symbols = c["n_symbols"] / chars
    vote(1, symbols < 0.005, symbols > 0.04)
    repeats = c["n_repeat_words"] / n
    vote(2, repeats < 0.2, repeats > 0.5)
    capitals = upper / np.maximum(upper + lower, 1)
    vote(3, (capitals < 0.1) & (lower > 0), capitals > 0.4)
    mean = chars / n
    vote(4, (mean > 3.5) & (mean < 8.5) & (c["n_words"] > 0), (mean < 2.2) | (mean > 13) | (c["n_words"] == 0))
    letters = (upper + lower + beyond) / chars
    vote(5, letters > 0.9, letters < 0.75)
    variety = distinct / np.sqrt(n)
    vote(6, variety > 4, (variety < 2.5) & (c["n_words"] >= 12))
    twice = np.zeros(len(h), bool)
    twice[1:] = (h[1:] == h[:-1]) & (words.row[1:] == words.row[:-1])
    stutter = per_row(twice, words.first) / n
    vote(7, (stutter < 0.05) & (c["n_words"] >= 12), stutter > 0.25)
    # words without a letter or digit, and words with two symbols or more
    inside = np.zeros(len(chunk.data) + 1, np.int64)
    np.cumsum(_TEXT[chunk.data], out=inside[1:])
    bare = per_row(inside[words.end] == inside[words.start], words.first) / n
    vote(8, (bare < 0.02) & (c["n_words"] > 0), bare > 0.15)
    np.cumsum(_MARK[chunk.data], out=inside[1:])
    marked = per_row(inside[words.end] - inside[words.start] >= 2, words.first) / n
    vote(9, (marked < 0.02) & (c["n_words"] > 0), marked > 0.2)
    return out


def pattern(chunk: Chunk, words: Words) -> np.ndarray:
    return votes(chunk, words) @ (3 ** np.arange(len(LABELLERS)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100,
             specific: tuple[float, float] | None = SPECIFIC) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: each pattern's posterior of good, P(vote | class) per labeller, and the share of good.

    ``specific`` says what is known of the labellers beforehand: a good
    document gets a bad vote at most, and a bad one at least, this often.
    """
    digits = (patterns[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
    onehot = np.eye(3)[digits]
    onehot[:, :, NONE] = 0  # who does not vote says nothing
    # from the majority of votes, a bad vote weighing more: bad signs are specific
    lean = (digits == GOOD).sum(1) - 2.0 * (digits == BAD).sum(1)
    good = 1 / (1 + np.exp(-lean))
    for _ in range(rounds):
        w = np.stack([counts * (1 - good), counts * good])
        table = np.einsum("cp,pkv->ckv", w, onehot) + np.array([0.5, 0, 0.5])
        table /= table.sum(2, keepdims=True)
        if specific:
            table[1, :, BAD] = np.minimum(table[1, :, BAD], specific[0])
            table[0, :, BAD] = np.maximum(table[0, :, BAD], specific[1])
            table /= table.sum(2, keepdims=True)
        prior = (w.sum(1) + 1) / (w.sum() + 2)
        ll = np.einsum("pkv,ckv->pc", onehot, np.log(np.maximum(table, 1e-9))) + np.log(prior)
        good = 1 / (1 + np.exp(np.clip(ll[:, 0] - ll[:, 1], -30, 30)))
    return good, table, float(prior[1])


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> tuple[Model, dict[int, float], dict[str, np.ndarray]]:
    """The scorer, the posterior of each vote pattern, and each labeller's P(vote | class)."""
    body = quoted(text).cast("string")
    source = docs.select(body.alias("text"), F.xxhash64(body, F.lit(5)).alias("hash"))
    voted = map_text(source, "text", [T.StructField("pattern", T.LongType())],
                     lambda chunk, batch: {"pattern": pattern(chunk, Words(chunk.data, chunk.off, NOT_SPACE))}, keep=["hash"])
    # copies of a text have one pattern
    rows = (voted.groupBy("pattern", "hash").count()
            .groupBy("pattern").agg(F.sum("count").alias("count"), F.count("*").alias("texts")).collect())
    if not rows:
        return fit([]), {}, {}
    rows.sort(key=lambda r: r["pattern"])
    patterns = np.array([r["pattern"] for r in rows])
    counts = np.array([r["count"] for r in rows], float)
    good, table, _ = estimate(patterns, counts)
    posterior = dict(zip(patterns.tolist(), good.tolist()))
    # the same share of every pattern's texts would leave rare patterns out: at most an equal part of each class
    texts = np.array([r["texts"] for r in rows], float)
    bad_total, good_total = (texts * (good < 0.5)).sum(), (texts * (good >= 0.5)).sum()
    cut = {0: min(1.0, sample / 2 / max(bad_total, 1)), 1: min(1.0, sample / 2 / max(good_total, 1))}
    known = shared(docs.sparkSession, posterior)
    labelled = map_text(source, "text", [T.StructField("target", T.DoubleType())],
                        lambda chunk, batch: {"target": np.array([known().get(int(p), 0.5) for p in pattern(
                            chunk, Words(chunk.data, chunk.off, NOT_SPACE))])}, keep=["text", "hash"])
    chosen = (labelled.filter(F.when(F.col("target") >= 0.5, drawn(F.col("hash"), cut[1])).otherwise(drawn(F.col("hash"), cut[0])))
              .select("text", "target").distinct()
              .select("text", "target", F.pmod(F.xxhash64("text", F.lit(13)), F.lit(1024)).alias("fold")).limit(2 * sample))
    model = fit(features(chosen, "text", "target", "fold"))
    accuracy = {name: table[:, k] for k, name in enumerate(LABELLERS)}
    return model, posterior, accuracy


def classify(docs: DataFrame, text: str = "text", keep: list[str] | None = None, sample: int = SAMPLE) -> DataFrame:
    """Adds n_good and n_bad votes, the weak posterior, the scorer's probability and kept."""
    model, posterior, _ = train(docs, text, sample)
    sent = shared(docs.sparkSession, (model, posterior))
    fields = [T.StructField("n_good", T.LongType()), T.StructField("n_bad", T.LongType()),
              T.StructField("weak_probability", T.DoubleType()), T.StructField("probability", T.DoubleType()),
              T.StructField("kept", T.BooleanType())]

    def run(chunk: Chunk, batch: pa.RecordBatch) -> dict:
        scorer, known = sent()
        words = Words(chunk.data, chunk.off, NOT_SPACE)
        v = votes(chunk, words)
        weak = np.array([known.get(int(p), 0.5) for p in v @ (3 ** np.arange(len(LABELLERS)))])
        p = scorer.probability(chunk, words)
        return {"n_good": (v == GOOD).sum(1), "n_bad": (v == BAD).sum(1), "weak_probability": weak, "probability": p,
                "kept": p >= KEEP_PROBABILITY}

    return map_text(docs, text, fields, run, keep)

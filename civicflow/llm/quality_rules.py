"""Quality rules: base counts, then a calibrated hashed n-gram logistic regression against fixed thresholds.

The model (see ``linear``) is trained on a bounded sample of labelled rows
(``sample`` rows at most, chosen by a hash of the document id), calibrated on
a fold it was not trained on, and scored over all documents in Arrow batches.

Cases: a null or empty text has no words and fails the base rules; repeated
rows score alike; labels that are null, or without a document, are not used,
and of several labels for one document the mean counts; without usable labels
of both classes the model says the labelled rate (0.5 without labels), so the
base rules decide; an empty table gives no rows; input columns with the names
of result columns are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm.linear import Model, features, fit
from civicflow.llm.stages import shared
from civicflow.llm.textmap import NOT_SPACE, Chunk, Words, covered, drawn, map_text, mix, per_row, quoted, windows

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_PROBABILITY = 0.5
# labelled rows that the model is fitted on, at most
SAMPLE = 2500

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    return per_row(flags, off)


def duplicate_lines(chunk: Chunk) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    out = np.zeros(chunk.n, np.int64)
    raw = chunk.data.tobytes()
    for r in range(chunk.n):
        text = raw[chunk.off[r]:chunk.off[r + 1]]
        if b"\n" in text:
            lines = [line for line in text.split(b"\n") if line and line.split(None, 1)]
            out[r] = len(lines) - len(set(lines))
    return out


def base_counts(chunk: Chunk, words: Words) -> dict[str, np.ndarray]:
    starts = (chunk.data & 0xC0) != 0x80
    at, h = windows(words.hashes(), words.row, 3)
    # windows that are the same within one row
    key = mix(h + words.row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    sorted_key = key[order]
    twin = np.zeros(len(key), bool)
    if len(key) > 1:
        same = sorted_key[1:] == sorted_key[:-1]
        twin[order[1:]] |= same
        twin[order[:-1]] |= same
    repeat = covered(at[twin], 3, len(words.row))
    return {"n_words": words.count, "word_chars": _sums(starts & NOT_SPACE[chunk.data], chunk.off),
            "n_symbols": _sums(_SYMBOL[chunk.data], chunk.off), "n_dup_lines": duplicate_lines(chunk),
            "n_repeat_words": per_row(repeat, words.first)}


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
          sample: int = SAMPLE) -> Model:
    """Fits the model on at most ``sample`` labelled documents."""
    known = (labels.select(quoted(doc_id).cast("string").alias("id"), quoted(quality).cast("double").alias("target"))
             .filter("id is not null and target is not null").groupBy("id").agg(F.avg("target").alias("target")))
    total = known.count()
    part = drawn(F.xxhash64("id", F.lit(7)), sample / max(total, 1))
    # a bounded sample: its ids can be broadcast at any size of the labels
    chosen = known.filter(part).orderBy(F.xxhash64("id", F.lit(7)), "id").limit(sample)
    texts = (docs.select(quoted(doc_id).cast("string").alias("id"), quoted(text).alias("text"))
             .join(F.broadcast(chosen), "id").select("text", "target", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1024)).alias("fold"))
             .limit(2 * sample))
    return fit(features(texts, "text", "target", "fold"))


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds the base counts, base_failed, the probability of good quality and the verdict kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [*[T.StructField(c, T.LongType()) for c in names], T.StructField("base_failed", T.BooleanType()),
              T.StructField("probability", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    sent = shared(docs.sparkSession, model)

    def run(chunk: Chunk, batch: pa.RecordBatch) -> dict:
        words = Words(chunk.data, chunk.off, NOT_SPACE)
        out = base_counts(chunk, words)
        failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
        p = sent().probability(chunk, words)
        return out | {"base_failed": failed, "probability": p, "kept": ~failed & (p >= KEEP_PROBABILITY)}

    return map_text(docs, text, fields, run, keep)


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  keep: list[str] | None = None, sample: int = SAMPLE) -> DataFrame:
    """Trains on the labelled documents and scores all of them."""
    return score(docs, train(docs, labels, doc_id, text, sample=sample), text, keep)

"""Language identification with bit-sliced n-gram Bloom filters.

Every slot of the filter is a bitmask with one bit for each language, so a
lookup (the AND of ``HASHES`` slots) gives all languages that contain an
n-gram at once.  The counts of an n-gram's languages over a text (popcounts
per language), corrected for each language's false-positive rate, decide.

N-grams are 3, 4 and 5 characters of the lower-cased text, where every run of
other characters than letters is one boundary.  A language's filter holds the
n-grams of its training texts that are in at least ``MIN_DOCS`` of them, the
``GRAMS`` most frequent; the training texts are a bounded sample (about
``SAMPLE`` a language, chosen by a hash).

Cases: a null text, an empty one and one without a letter are ``und`` with
score 0, and so is everything when there is nothing to learn from; ties go to
the language that sorts first; repeated rows are predicted alike; null
languages are not learned; an empty table gives no rows; input columns with
the names of result columns are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm.stages import shared
from civicflow.llm.textmap import Chunk, drawn, emit_rows, map_text, mix, quoted, windows

NGRAMS = (3, 4, 5)
HASHES = 3
SLOT_BITS = 20
GRAMS = 30_000
# values of lang that a model tells apart, at most
LANGUAGES = 200
MIN_DOCS = 2
# training texts for each language, about
SAMPLE = 1000
UNDETERMINED = "und"

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters; made once in each worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(chunk: Chunk) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(row, hash) of the n-grams of each length, and the number of letters of each row."""
    texts = [" " + t.lower() + " " for t in chunk.strings()]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    letter = letter_table()[points]
    letters = np.bincount(row[letter], minlength=chunk.n)
    new = np.ones(len(points), bool)
    new[1:] = letter[:-1] | (row[1:] != row[:-1])
    stay = letter | new
    value = np.where(letter, points, 0)[stay].astype(np.uint64)
    row = row[stay]
    hashed = mix(value + np.uint64(1))
    out = []
    for n in NGRAMS:
        at, h = windows(hashed, row, n)
        out.append((row[at], h))
    return out, letters


@dataclass
class Model:
    languages: list[str]
    # slots x words of 64 languages
    filter: np.ndarray
    false_positive: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _slots(h: np.ndarray) -> list[np.ndarray]:
    m = np.uint64((1 << SLOT_BITS) - 1)
    return [((h >> np.uint64(SLOT_BITS * k)) & m).astype(np.int64) for k in range(HASHES)]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE,
          max_grams: int = GRAMS, max_languages: int = LANGUAGES) -> Model:
    """Learns one filter for each non-null language of ``docs``; ``key`` only draws the sample.

    The driver holds up to ``max_grams`` n-grams a language and a bit for each
    language in every slot; more than ``max_languages`` values of ``lang`` are
    an error, not left out.
    """
    known = docs.select(quoted(text).cast("string").alias("text"), quoted(lang).cast("string").alias("lang"),
                        F.xxhash64(quoted(key).cast("string"), F.lit(3)).alias("draw")
                        ).filter("lang is not null and text is not null")
    # one row for each language: bounded by the number of languages
    totals = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(max_languages + 1).collect()}
    if len(totals) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not totals:
        return Model([], np.zeros((1 << SLOT_BITS, 1), np.uint64))
    languages = sorted(totals)
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, sample / totals[name])])
    chosen = known.filter(drawn(F.col("draw"), share[F.col("lang")])).select("lang", "text")
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType())])

    def run(chunk: Chunk, batch: pa.RecordBatch) -> list:
        found, _ = grams(chunk)
        rows, keys = [], []
        for row, h in found:
            # each n-gram once a text
            order = np.lexsort((h, row))
            r, g = row[order], h[order]
            first = np.ones(len(r), bool)
            first[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1])
            rows.append(r[first])
            keys.append(g[first])
        return [batch.column(1).take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(keys).view(np.int64))]

    counted = emit_rows(chosen, "text", ["lang"], schema, run).groupBy("lang", "gram").count()
    # ties and texts alone: a language with few texts keeps what it has
    least = F.create_map(*[F.lit(x) for name in languages for x in (name, MIN_DOCS if totals[name] >= 20 else 1)])
    best = Window.partitionBy("lang").orderBy(F.col("count").desc(), "gram")
    # the sample is bounded, so are the n-grams of a language in its window
    top = (counted.filter(F.col("count") >= least[F.col("lang")]).withColumn("place", F.row_number().over(best))
           .filter(F.col("place") <= max_grams).select("lang", "gram").toPandas())
    words = -(-len(languages) // 64)
    table = np.zeros((1 << SLOT_BITS, words), np.uint64)
    fill = np.zeros(len(languages))
    for i, name in enumerate(languages):
        h = top["gram"].to_numpy(np.int64)[(top["lang"] == name).to_numpy()].view(np.uint64)
        mine = np.zeros(1 << SLOT_BITS, bool)
        for slot in _slots(h):
            mine[slot] = True
        table[mine, i // 64] |= np.uint64(1 << (i % 64))
        fill[i] = mine.mean()
    return Model(languages, table, fill ** HASHES)


def identify(chunk: Chunk, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each row: the corrected share of its n-grams that the language contains."""
    found, letters = grams(chunk)
    n = len(model.languages)
    if not n:
        return [UNDETERMINED] * chunk.n, np.zeros(chunk.n)
    counts, total = np.zeros((chunk.n, n)), np.zeros(chunk.n)
    for row, h in found:
        mask = model.filter[_slots(h)[0]]
        for slot in _slots(h)[1:]:
            mask = mask & model.filter[slot]
        total += np.bincount(row, minlength=chunk.n)
        for i in range(n):
            bit = (mask[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            counts[:, i] += np.bincount(row[bit.astype(bool)], minlength=chunk.n)
    some = np.maximum(total, 1)[:, None]
    fp = model.false_positive[None, :]
    share = np.clip((counts / some - fp) / (1 - fp), 0, 1)
    best = share.argmax(1)
    score = share[np.arange(chunk.n), best]
    lettered = letters > 0
    return [model.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), lettered.tolist())], np.where(lettered, score, 0.0)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds lang_pred and score; one narrow pass with the filter broadcast (``2**SLOT_BITS`` slots, whatever the input)."""
    sent = shared(docs.sparkSession, model)

    def run(chunk: Chunk, batch: pa.RecordBatch) -> dict:
        names, score = identify(chunk, sent())
        return {"lang_pred": names, "score": score}

    return map_text(docs, text, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], run, keep)


def held_out(key: str = "doc_id") -> Column:
    """The fold that is never learned: crc32 of the id as text leaves 2 divided by 4 (a null id is learned)."""
    return F.coalesce(F.crc32(quoted(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))

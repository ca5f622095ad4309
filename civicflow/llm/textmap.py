"""Arrow batches of texts as flat byte arrays, and vectorised word work on them.

A chunk is a bounded run of rows (about ``CHUNK_BYTES`` of text, at least one
row): memory in a Python worker follows the chunk, or the longest single
text, never the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CHUNK_BYTES = 1 << 18
# rows per Arrow batch: the JVM side holds one batch of whole texts
BATCH_ROWS = 1000

# odd multipliers of the polynomial hashes (mod 2**64) and their inverses
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per worker up to the largest n asked for."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), np.uint64(base & _MASK), dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """Rows of one string column: their UTF-8 bytes, row offsets and which are null."""

    def __init__(self, column: pa.Array):
        self.n = len(column)
        self.column = column
        self.null = np.asarray(column.is_null()) if self.n else np.zeros(0, bool)
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        _, offsets, data = column.buffers()
        off = np.frombuffer(offsets, kind)[column.offset:column.offset + self.n + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = raw[off[0]:off[-1]]
        self.off = off - off[0]

    def strings(self) -> list[str]:
        """The texts; null is empty."""
        return [t or "" for t in self.column.to_pylist()]

    def points(self) -> np.ndarray:
        """For each byte position (and one past the end): code points that start before it, over the whole chunk."""
        out = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=out[1:])
        return out


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a column of about ``limit`` bytes each, at least one row."""
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    off = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + n + 1].astype(np.int64)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def drawn(hashed: Column, rate: Column | float) -> Column:
    """Whether a row of this 64-bit hash is in a sample of this rate; by 62 bits, so that no table is too large for it."""
    return hashed.bitwiseAND(F.lit((1 << 62) - 1)) < (F.least(F.lit(rate), F.lit(1.0)) * float(1 << 62)).cast("long")


def others(columns: list[str], taken: list[str]) -> list[str]:
    """Columns whose names differ from all taken ones (upper and lower case alike)."""
    low = {t.lower() for t in taken}
    return [c for c in columns if c.lower() not in low]


def map_text(docs: DataFrame, text: str, fields: list[T.StructField],
             fn: Callable[[Chunk, pa.RecordBatch], dict], keep: list[str] | None = None) -> DataFrame:
    """Adds the columns that ``fn`` makes of each chunk of texts.

    ``keep``: the input columns to carry (all unless given).  An input column
    with the name of a new one is replaced; ``fn`` still sees it in its batch
    when kept.  A narrow map over Arrow batches: no shuffle, nothing held
    beyond a chunk, and a lost task is simply run again.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    carried = list(docs.columns if keep is None else keep)
    # positions, not names: the input may hold any names
    source = docs.select(quoted(text).cast("string").alias("t"),
                         *[quoted(c).alias(f"c{i}") for i, c in enumerate(carried)])
    names = [f.name for f in fields]
    stay = [i for i, c in enumerate(carried) if c in others(carried, names)]
    types = source.schema
    schema = T.StructType([T.StructField(carried[i], types[i + 1].dataType, True) for i in stay] + list(fields))

    def run(batches):
        out_schema = to_arrow_schema(schema)
        for batch in batches:
            for lo, hi in chunks(batch.column(0)):
                part = batch.slice(lo, hi - lo)
                made = fn(Chunk(part.column(0)), part)
                arrays = [part.column(i + 1) for i in stay]
                for f in names:
                    kind = out_schema.field(f).type
                    v = made[f]
                    arrays.append(v if isinstance(v, pa.Array) and v.type == kind else pa.array(v, type=kind))
                yield pa.RecordBatch.from_arrays(
                    [a if a.type == k.type else a.cast(k.type) for a, k in zip(arrays, out_schema)], schema=out_schema)

    return source.mapInArrow(run, schema)


def emit_rows(docs: DataFrame, text: str, keys: list[str], schema: T.StructType,
              fn: Callable[[Chunk, pa.RecordBatch], list]) -> DataFrame:
    """Any number of rows for each chunk: ``fn`` returns the arrays of ``schema``; its batch has the keys from column 1 on."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    source = docs.select(quoted(text).cast("string").alias("t"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(keys)])

    def run(batches):
        out_schema = to_arrow_schema(schema)
        for batch in batches:
            for lo, hi in chunks(batch.column(0)):
                part = batch.slice(lo, hi - lo)
                made = fn(Chunk(part.column(0)), part)
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, type=f.type)
                                                  for v, f in zip(made, out_schema)], schema=out_schema)

    return source.mapInArrow(run, schema)


# word characters: everything but ASCII white space
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# digits, letters and everything beyond ASCII, for text lower-cased in A-Z
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Words:
    """Words of a chunk: byte ranges, the row of each, words before each row, and 64-bit hashes."""

    def __init__(self, data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
        n = len(data)
        self.data, self.off = data, off
        mask = is_word[data]
        before = np.zeros(n, bool)
        before[1:] = mask[:-1]
        edge = off[:-1]
        before[edge[edge < n]] = False
        after = np.zeros(n, bool)
        after[:-1] = mask[1:]
        edge = off[1:] - 1
        after[edge[edge >= 0]] = False
        self.start = np.flatnonzero(mask & ~before)
        self.end = np.flatnonzero(mask & ~after) + 1
        self.row = np.searchsorted(off, self.start, side="right") - 1
        # words before each row, and in all
        self.first = np.searchsorted(self.start, off, side="left")
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers(BYTE_BASE, n), out=sums[1:])
        back = powers(inverse(BYTE_BASE), n + 1)
        h = (sums[self.end] - sums[self.start]) * back[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64) * np.uint64(WORD_BASE))


def windows(hashes: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where ``width`` words of one row begin, and a 64-bit hash of each such window."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(WORD_BASE, len(hashes)), out=sums[1:])
    at = np.flatnonzero(row[:n] == row[width - 1:])
    return at, mix((sums[at + width] - sums[at]) * powers(inverse(WORD_BASE), len(hashes) + 1)[at])


def covered(at: np.ndarray, width, n: int) -> np.ndarray:
    """Which of n positions lie in [at, at + width) for some at."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + width, -1)
    return np.cumsum(delta[:n]) > 0


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of word-wise values over each row."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[first])

"""Large JSON list files, read in ranges.

The file is split at ``}``, which every object of a list ends with.  Inside a
range brackets count only outside strings, and whether the range starts inside
a string depends on the quotes before it: two states, and a range either
swaps them or not.  The depth of brackets and the elements before a range are
sums over the ranges before it.  So each task sums up its range for both
states, the sums are folded in file order, and then each task cuts the list
at the commas of depth 1 and knows the position of each element.  Elements
that straddle ranges are put together from their fragments.
"""

from __future__ import annotations

import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.sources.ranges import pieces, runs, summed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEPARATOR = "}"
_BLANK = b" \t\n\r"
_NEVER = 1 << 60


class Marks(NamedTuple):
    """Places of quotes, brackets and commas in a text; brackets and commas with the quotes before each."""

    quotes: int
    at: np.ndarray
    sign: np.ndarray
    before: np.ndarray


def marks(text: bytes) -> Marks:
    """The marks of a text that starts behind ``}`` or at the start of a file; ``sign``: 1 opens, -1 closes, 0 a comma."""
    d = np.frombuffer(text, np.uint8)
    quote = d == 0x22
    slash = np.flatnonzero(d == 0x5C)
    if len(slash):
        # a character is escaped by an odd run of backslashes before it
        first = np.ones(len(slash), bool)
        first[1:] = np.diff(slash) > 1
        run = np.arange(len(slash)) - np.maximum.accumulate(np.where(first, np.arange(len(slash)), 0))
        escaped = slash[run % 2 == 0] + 1
        quote[escaped[escaped < len(d)]] = False
    at = np.flatnonzero(np.isin(d, np.frombuffer(b"[]{},", np.uint8)))
    sign = np.select([(d[at] == 0x5B) | (d[at] == 0x7B), d[at] != 0x2C], [1, -1], 0)
    where = np.flatnonzero(quote)
    return Marks(len(where), at, sign, np.searchsorted(where, at))


def structure(m: Marks, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, signs, depths after) of the marks outside strings, for a text that starts inside a string or not; depth from 0."""
    real = (m.before + inside) % 2 == 0
    sign = m.sign[real]
    return m.at[real], sign, np.cumsum(sign)


class Range:
    """Sums of a range, for each state at its start: quotes, change of depth, commas by depth, and the least depth."""

    def __init__(self):
        self.odd = False
        self.depth = [0, 0]
        self.commas: list[dict[int, int]] = [{}, {}]
        self.low = [_NEVER, _NEVER]
        self.first = ""

    def add(self, parts: list[bytes]) -> None:
        text = b"}".join([*parts, b""])
        if not self.first and (start := text.lstrip(_BLANK)):
            self.first = chr(start[0])
        m = marks(text)
        for state in (0, 1):
            at, sign, depth = structure(m, bool(state) != self.odd)
            found, count = np.unique(depth[sign == 0] + self.depth[state], return_counts=True)
            for d, n in zip(found.tolist(), count.tolist()):
                self.commas[state][d] = self.commas[state].get(d, 0) + n
            self.low[state] = min(self.low[state], int(depth.min(initial=_NEVER)) + self.depth[state])
            self.depth[state] += int(sign.sum())
        self.odd ^= bool(m.quotes % 2)

    def row(self) -> tuple:
        return self.odd, self.depth, [list(c) for c in self.commas], [list(c.values()) for c in self.commas], self.low, self.first


SCHEMA = "odd boolean, depth array<long>, levels array<array<long>>, commas array<array<long>>, low array<long>, first string"


def entries(spark: SparkSession, files: list[str]) -> tuple[dict[tuple[str, int], tuple[bool, int, int]], list[str], list[str]]:
    """For each range (file, start) of the lists: inside a string, the depth, and the position of the element there.

    Also the files that are no list (one document, or nothing of the kind) and
    the lists that never end.
    """
    entry: dict[tuple[str, int], tuple[bool, int, int]] = {}
    others, broken = [], []
    for file, ranges in summed(pieces(spark, files, SEPARATOR), SCHEMA, Range).items():
        if next((r["first"] for r in ranges if r["first"]), "") != "[":
            others.append(file)
            continue
        inside, depth, place, closed = False, 0, 0, False
        for r in ranges:
            # text behind the list is none of it, as Spark's parser has it
            entry[file, r["start"]] = (inside, 0 if closed else depth, place)
            state = int(inside)
            place += dict(zip(r["levels"][state], r["commas"][state])).get(1 - depth, 0)
            closed |= depth + r["low"][state] <= 0
            depth += r["depth"][state]
            inside ^= r["odd"]
        if not closed:
            broken.append(file)
    return entry, others, broken


def elements(spark: SparkSession, files: list[str], entry: dict[tuple[str, int], tuple[bool, int, int]]) -> DataFrame:
    """(file, pos, text) of every element of the lists."""
    sent = spark.sparkContext.broadcast(entry)

    def cut(batches):
        out: list[tuple] = []
        at, held, inside, depth, place, whole, over = None, b"", False, 0, 0, True, False

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (
                pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()))], names=["file", "pos", "seq", "whole", "last", "text"])

        for file, start, _, parts in runs(batches):
            if (file, start) != at:
                if at is not None and not over:
                    out.append((at[0], place, at[1], False, False, held))
                at, held = (file, start), b""
                inside, depth, place = sent.value[at]
                # what a range starts with is the rest of an element, but at the start of the file
                whole, over = start == 0, depth <= 0 and start > 0
            if over:
                continue
            text = b"}".join([*parts, b""])
            m = marks(text)
            places, sign, after = structure(m, inside)
            after = after + depth
            # the bracket that opens the list, the commas of its level, and what closes it
            ends = np.flatnonzero((sign == -1) & (after <= 0))
            stop = int(ends[0]) + 1 if len(ends) else len(places)
            real = np.flatnonzero(((sign[:stop] == 0) & (after[:stop] == 1)) | ((sign[:stop] == 1) & (after[:stop] == 1)) & (
                np.arange(stop) == 0) & (start == 0) & (depth == 0))
            lo = 0
            for k in real.tolist():
                p = int(places[k])
                if sign[k] == 1:
                    lo, held = p + 1, b""
                    continue
                out.append((file, place, start, whole, False, held + text[lo:p]))
                held, lo, whole, place = b"", p + 1, True, place + 1
            if len(ends):
                p = int(places[stop - 1])
                # a list closed by something else gives an element that does not parse
                body = held + text[lo:p] + (b"" if text[p] == 0x5D else b"\\")
                out.append((file, place, start, whole, True, body))
                over = True
            else:
                held += text[lo:]
                depth = int(after[-1]) if len(after) else depth
                inside ^= bool(m.quotes % 2)
            if len(out) >= 1000:
                yield flush()
        if at is not None and not over:
            out.append((at[0], place, at[1], False, False, held))
        if out:
            yield flush()

    schema = "file string, pos long, seq long, whole boolean, last boolean, text binary"
    found = pieces(spark, files, SEPARATOR).mapInArrow(cut, schema)
    alone = found.filter("whole").select("file", "pos", "last", F.col("text").cast("string").alias("text"))
    # the fragments of one element: at most one of each range it lies in
    joined = (found.filter("not whole").groupBy("file", "pos")
              .agg(F.max("last").alias("last"), F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("parts"))
              .select("file", "pos", "last", F.array_join(F.transform("parts", lambda p: p["text"].cast("string")), "").alias("text")))
    # an empty list has no element
    empty = F.col("last") & (F.col("pos") == 0) & (F.regexp_replace("text", r"\s+", "") == "")
    return alone.unionByName(joined).filter(~empty).select("file", "pos", "text")

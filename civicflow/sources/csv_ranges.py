"""Large CSV files with quoted line breaks, read in ranges.

A line break ends a record unless it lies inside quotes.  At the start of a
line a reader is either at the start of a record or inside quotes, so what a
line does is a function of two states to two states, and so is what a range
of lines does.  Quotes open a field only at its start, as Spark's reader has
it: a quote within an unquoted field is text, a doubled quote within quotes
is one, and text after a closing quote makes the field unquoted.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.sources.ranges import pieces, runs, summed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE, DELIMITER = b'"', b","
# places within a line: at the start of a field, in an unquoted one, inside quotes, behind a quote inside quotes
_START, _PLAIN, _QUOTED, _BEHIND = range(4)


def quoted_after(line: bytes, quoted: bool) -> bool:
    """Whether a line that starts inside quotes (or not) ends inside quotes."""
    if QUOTE not in line:
        return quoted
    place = _QUOTED if quoted else _START
    parts = line.split(QUOTE)
    for i, part in enumerate(parts):
        if i:
            place = (_QUOTED, _PLAIN, _BEHIND, _QUOTED)[place]
        if part and place != _QUOTED:
            place = _START if part.endswith(DELIMITER) else _PLAIN
    return place == _QUOTED


class Range:
    """What a range of lines does: where each of the two states leads, whether a record that comes in open ends here,
    whether any line leads from the start of a record into quotes, and its bytes with an end for each line."""

    def __init__(self):
        self.out, self.inside, self.closes, self.opens, self.bytes = False, True, False, False, 0

    def add(self, lines: list[bytes]) -> None:
        self.bytes += sum(map(len, lines)) + len(lines)
        for line in lines:
            if QUOTE in line:
                opens = quoted_after(line, False)
                self.opens |= opens
                self.out = quoted_after(line, True) if self.out else opens
                self.inside = quoted_after(line, True) if self.inside else opens
                self.closes |= not self.inside

    def row(self) -> tuple:
        return self.out, self.inside, self.closes, self.opens, self.bytes


def profile(spark: SparkSession, files: list[str]) -> dict[str, dict]:
    """For each file: its header, whether it has quotes, and how its lines end."""
    lines = pieces(spark, files, "\n").select("file", "start", F.col("piece").cast("string").alias("line"), F.monotonically_increasing_id().alias("at"))
    ends = F.col("line").endswith("\r")
    order = F.struct("start", "at")
    found = lines.groupBy("file").agg(
        F.min_by("line", order).alias("first"), F.max(F.contains("line", F.lit('"'))).alias("quotes"),
        F.count("*").alias("lines"), F.count_if(ends).alias("crlf"),
        F.max(F.regexp_like(F.col("line"), F.lit(r"\r(?!\z)"))).alias("lone"),
        # the last line may lack its end
        F.max_by(ends, order).alias("last_crlf"))
    out = {}
    for r in found.collect():
        even = not r["lone"] and (r["crlf"] == 0 or r["crlf"] == r["lines"] or (r["crlf"] == r["lines"] - 1 and not r["last_crlf"]))
        first = r["first"].removesuffix("\r")
        out[r["file"]] = {"header": first.removeprefix("\ufeff"), "crlf": r["first"].endswith("\r"), "quotes": r["quotes"], "even": even,
                          # read by one task: a header of several lines, or line ends that are none here
                          "odd": "\r" in first or quoted_after(first.encode(), False)}
    return out


def entries(spark: SparkSession, files: list[str]) -> tuple[dict[tuple[str, int], tuple[bool, int, bool]], set[str]]:
    """For each range (file, start): whether it starts inside quotes, the range in which the record open there began,
    and whether it ends the file with a line end inside quotes.

    Also the files in which a line may lead into quotes: the others have no record of several lines.
    """
    entry: dict[tuple[str, int], tuple[bool, int, bool]] = {}
    opening = set()
    schema = "out boolean, inside boolean, closes boolean, opens boolean, bytes long"
    for file, ranges in summed(pieces(spark, files, "\n"), schema, Range).items():
        quoted, owner = False, 0
        for r in ranges:
            before, owner = quoted, owner if quoted else r["start"]
            quoted = r["inside"] if quoted else r["out"]
            ended = r is ranges[-1] and quoted and sum(x["bytes"] for x in ranges) == r["size"]
            entry[file, r["start"]] = (before, owner, ended)
            if not before or r["closes"]:
                owner = r["start"]
            if r["opens"]:
                opening.add(file)
    return entry, opening


def records(spark: SparkSession, files: list[str], entry: dict[tuple[str, int], tuple[bool, int, bool]], crlf: bool) -> DataFrame:
    """(file, record): the text of every record but the first of each file, its header."""
    sent = spark.sparkContext.broadcast(entry)

    def cut(batches):
        out: list[tuple] = []
        at, held, quoted, owner, whole, ended = None, [], False, 0, True, False

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [(), (), (), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (
                pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()))], names=["file", "owner", "seq", "whole", "record"])

        for file, start, _, lines in runs(batches):
            if (file, start) != at:
                if held:
                    # open at the end of its range
                    out.append((at[0], owner, at[1], False, b"\n".join([*held, *[b""] * ended])))
                at, held = (file, start), []
                quoted, owner, ended = sent.value[at]
                # the rest of a record that began in an earlier range is a fragment
                whole = not quoted
                header = start == 0
            for line in lines:
                held.append(line)
                quoted = quoted_after(line, quoted)
                if not quoted:
                    if not (header and whole):
                        out.append((file, owner, start, whole, b"\n".join(held)))
                    held, whole, owner, header = [], True, start, False
            if len(out) >= 1000:
                yield flush()
        if held:
            out.append((at[0], owner, at[1], False, b"\n".join([*held, *[b""] * ended])))
        if out:
            yield flush()

    schema = "file string, owner long, seq long, whole boolean, record binary"
    found = pieces(spark, files, "\n").mapInArrow(cut, schema)
    alone = found.filter("whole").select("file", "record")
    # the fragments of one record: at most one of each range it lies in
    joined = (found.filter("not whole").groupBy("file", "owner")
              .agg(F.array_sort(F.collect_list(F.struct("seq", "record"))).alias("parts"))
              .select("file", F.array_join(F.transform("parts", lambda p: p["record"].cast("string")), "\n").cast("binary").alias("record")))
    text = F.col("record").cast("string")
    if crlf:
        # as Spark's reader has it, also inside quotes
        text = F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"\r\z", "")
    # empty lines are no records
    return alone.unionByName(joined).select("file", text.alias("record")).filter("record <> ''")

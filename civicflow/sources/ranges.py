"""Large text files in byte ranges, one task each, with what a range must know of the ones before it.

Spark's text reader splits a file at a separator of our choice, on any store
it can read.  A format that quotes its separators cannot be cut there blindly:
whether a separator counts depends on all text before it.  So a large file is
read twice.  First each task sums up its range: how the state at its start
leads to the state at its end.  The summaries, one short row for each range,
are folded in file order; then each task knows the state that its range starts
in and cuts records itself.  A record that straddles ranges is put together
from its fragments, the only rows that are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# tasks need no copy of the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed values: endings of files that are compressed as a whole and cannot be split
COMPRESSED = (".gz", ".bz2", ".zst", ".zstd", ".lz4", ".snappy", ".deflate", ".xz")


def split_bytes(spark: SparkSession) -> int:
    """Bytes of a split: a larger file is worth more than one task."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes", "128m").lower().removesuffix("b")
    factor = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1])
    return int(text[:-1]) * factor if factor else int(text)


def listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length) of the files below ``path``; their contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


def large_files(files: DataFrame, split: int) -> list[str]:
    """The files beyond a split that can be read in ranges: names only, at most one for each split of the data."""
    splittable = F.lit(True)
    for ending in COMPRESSED:
        splittable &= ~F.lower("path").endswith(ending)
    return sorted(r["path"] for r in files.filter((F.col("length") > split) & splittable).collect())


def listed(file_path: str) -> str:
    """The path, as a listing has it, of a ``_metadata.file_path``."""
    return unquote(file_path)


def pieces(spark: SparkSession, files: list[str], separator: str) -> DataFrame:
    """(file, start, size, piece): the bytes between separators, in file order within each range (file, start)."""
    return (spark.read.option("lineSep", separator).text(files)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                    F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece")))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list[bytes]]]:
    """The rows of ``pieces`` as (file, start, size, pieces), parts of one range after the other."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column(0), batch.column(1).to_numpy()
        rows = batch.column(3).to_pylist()
        # ranges change seldom: the file is looked at where its neighbour differs in start or name
        codes = files.dictionary_encode().indices.to_numpy()
        cuts = [0, *[i for i in range(1, len(rows)) if starts[i] != starts[i - 1] or codes[i] != codes[i - 1]], len(rows)]
        for lo, hi in zip(cuts, cuts[1:]):
            yield files[lo].as_py(), int(starts[lo]), batch.column(2)[lo].as_py(), rows[lo:hi]


def summed(parts: DataFrame, schema: str, begin: Callable[[], object]) -> dict[str, list]:
    """For each file its summaries in file order.

    ``begin()`` gives an object whose ``add(pieces)`` takes the parts of a
    range in order and whose ``row()`` is its summary, the columns of
    ``schema``.
    """
    def run(batches):
        at, state = None, None
        for file, start, size, part in runs(batches):
            if (file, start) != at:
                if state is not None:
                    yield _row(at, last, state)
                at, state = (file, start), begin()
            last = size
            state.add(part)
        if state is not None:
            yield _row(at, last, state)

    def _row(at, size, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(arrow.names, [*at, size, *state.row()]))], schema=arrow)

    full = T.StructType.fromDDL(f"file string, start long, size long, {schema}")
    arrow = to_arrow_schema(full)
    out: dict[str, list] = {}
    # one short row for each range: the driver folds them
    for r in sorted(parts.mapInArrow(run, full).collect(), key=lambda r: (r["file"], r["start"])):
        out.setdefault(r["file"], []).append(r)
    return out

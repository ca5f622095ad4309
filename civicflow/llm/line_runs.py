"""Line dedup: levelled sorted runs of line hashes that each new batch of documents is merged with.

A line's key is the line without ASCII white space at both ends, A-Z in lower
case; it is known by 128 bits of its digest.  ``LineRuns`` holds the keys seen
so far as sorted runs:

* a run is a table bucketed by key and sorted in each bucket, so joins with it
  neither shuffle nor sort it again;
* a new batch is counted by key and merge-anti-joined with one run after the
  other, in the partitions that it already has; the keys that no run holds
  become a run of level 0, the others are noted as seen again;
* when a level has ``FANOUT`` runs, they are merged into one of the next level:
  a key lies in one run only, and a batch meets few runs for each level.

``drop_lines`` hands the documents over in batches of falling ids.  The first
batch that holds a key then has the largest document with it, and later
batches only add to its count; at the end the keys with enough documents lose
their lines everywhere else.

Cases: a null or empty text is one empty line (null comes back as an empty
text); rows that share an id are one document; rows without an id are one
document too, below all others; a key that one document repeats counts once;
an empty table gives no rows; input columns with the names of result columns
are replaced.  Any text length is fine: memory follows one text.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow import session
from civicflow.llm.stages import released_shuffles, written
from civicflow.llm.textmap import Chunk, emit_rows, map_text, others, quoted

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
BATCHES = 4
FANOUT = 2
# fixed value: white space that the ends of a line lose
SPACE = " \t\n\v\f\r"
KEY = ["hi", "lo"]

_KEYS = T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType()), T.StructField("doc", T.LongType())])


def digest(line: str, least_chars: int = LEAST_CHARS) -> bytes | None:
    """16 bytes that stand for a line's key; None if the key is too short to count."""
    key = line.strip(SPACE)
    # bytes.lower changes A-Z alone
    return hashlib.blake2b(key.encode().lower(), digest_size=16).digest() if len(key) >= least_chars else None


def line_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(hi, lo, doc): the keys that count, each once a row of ``docs``."""

    def run(chunk: Chunk, batch: pa.RecordBatch) -> list:
        keys, rows = [], []
        for row, body in enumerate(chunk.strings()):
            found = {digest(line, least_chars) for line in body.split("\n")} - {None}
            keys += found
            rows += [row] * len(found)
        halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
        return [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column(1).take(pa.array(rows, pa.int64()))]

    keyed = docs.select(quoted(doc_id).cast("long").alias("doc"), quoted(text).alias("text"))
    return emit_rows(keyed, "text", ["doc"], _KEYS, run)


# runs are read by bucket, sorted where a bucket is one file; merged runs are dealt into one file a bucket again;
# no join is planned as a broadcast while a run happens to be small
_MERGING = {"spark.sql.unionOutputPartitioning": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@contextmanager
def merging(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in _MERGING}
    for k, v in _MERGING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class LineRuns:
    """Keys seen so far, as levelled sorted runs (hi, lo, docs, keeper), and the keys of later batches seen again."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = session.scratch(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.again: list[str] = []
        self.made: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        """``rows`` as a table bucketed and sorted by key."""
        name = f"line_run_{self.folder.rsplit('-', 1)[-1]}_{len(self.made)}"
        with released_shuffles(self.spark), merging(self.spark):
            (rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
             .option("path", f"{self.folder}/{name}").option("compression", "zstd").format("parquet").saveAsTable(name))
        self.made.append(name)
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` whose key is in no run: one merge anti-join after the other, in one partitioning."""
        for name in self.runs():
            keys = keys.join(self.spark.table(name).select(*KEY).hint("merge"), KEY, "left_anti")
        return keys

    def add(self, keys: DataFrame) -> None:
        """Adds a batch (hi, lo, docs, keeper) of distinct keys; its documents have no larger ids than those before."""
        if not self.runs():
            self.levels = [[self._write(keys)]]
            return
        batch = self._write(keys)
        rows = self.spark.table(batch)
        new = self._write(self.unseen(rows))
        # what the batch holds beside its new keys: again a merge anti-join, with its own run
        self.again.append(self._write(rows.join(self.spark.table(new).select(*KEY).hint("merge"), KEY, "left_anti").select(*KEY, "docs")))
        self._drop(batch)
        self.levels[0].append(new)
        self._compact()

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            parts = self.levels[level]
            merged = self._write(reduce(DataFrame.unionByName, map(self.spark.table, parts)))
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level], self.levels[level + 1] = [], [*self.levels[level + 1], merged]
            for name in parts:
                self._drop(name)
            level += 1

    def _drop(self, name: str) -> None:
        """Forgets a table; its files go, they are this store's own scratch."""
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def counted(self) -> DataFrame:
        """(hi, lo, docs, keeper) of every key, with the documents of all batches."""
        runs = reduce(DataFrame.unionByName, [self.spark.table(n) for n in self.runs()])
        if not self.again:
            return runs
        more = reduce(DataFrame.unionByName, [self.spark.table(n) for n in self.again])
        more = more.groupBy(*KEY).agg(F.sum("docs").alias("more"))
        return runs.join(more, KEY, "left").select(*KEY, (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"), "keeper")

    def close(self) -> None:
        for name in self.made:
            self._drop(name)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def drop_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
               least_documents: int = LEAST_DOCUMENTS, batches: int = BATCHES, fanout: int = FANOUT,
               keep: list[str] | None = None) -> DataFrame:
    """Documents without the lines that ``least_documents`` or more share, but in the largest id that holds them.

    Adds n_lines, n_dropped and kept_text to the columns to keep (all unless given).
    """
    spark = docs.sparkSession
    session.configure(spark)
    names = list(docs.columns)
    # bounds of the batches: every id lies in one batch, whatever the split
    cuts = docs.select(F.percentile_approx(quoted(doc_id).cast("long"), [i / batches for i in range(1, batches)], 1000)).first()[0] if batches > 1 else None
    place = F.lit(0)
    for cut in sorted(set(cuts or [])):
        place = place + F.when(F.col("doc") > cut, 1).otherwise(0)
    lines = written(line_keys(docs, doc_id, text, least_chars).withColumn("part", F.coalesce(place, F.lit(0))), "line-keys", ["part"])
    store = LineRuns(spark, fanout)
    try:
        for part in range(len(set(cuts or [])), -1, -1):
            # a document counts once a key, however many rows it has; both steps add up before they shuffle
            one = lines.filter(F.col("part") == part).select(*KEY, "doc").distinct()
            store.add(one.groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("doc").alias("keeper")))
        frequent = written(store.counted().filter(F.col("docs") >= least_documents).select(*KEY, "keeper"), "line-frequent")
    finally:
        store.close()
    gone = (lines.join(frequent, KEY).filter(~_same(F.col("doc"), F.col("keeper")))
            .groupBy("doc").agg(F.collect_set(F.struct(*KEY)).alias("gone")))
    gone = written(gone, "line-gone")
    stay = others([c for c in names if keep is None or c in keep], ["n_lines", "n_dropped", "kept_text"])
    source = docs.select(quoted(text).cast("string").alias("t"), quoted(doc_id).cast("long").alias("d"),
                         *[quoted(c).alias(f"c{names.index(c)}") for c in stay])
    joined = source.join(gone, _same(F.col("d"), F.col("doc")), "left").drop("doc", "d")
    carried = [f"c{names.index(c)}" for c in stay]
    fields = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())]

    def run(chunk: Chunk, batch: pa.RecordBatch) -> dict:
        lost = batch.column(len(carried) + 1)
        halves = lost.flatten()
        both = np.stack([np.asarray(halves.field(0), np.int64), np.asarray(halves.field(1), np.int64)], axis=1).tobytes()
        at = np.concatenate([[0], np.cumsum(np.asarray(lost.value_lengths().fill_null(0)))]) * 16
        n_lines, n_dropped, kept = [], [], []
        for row, body in enumerate(chunk.strings()):
            split = body.split("\n")
            own = {both[i:i + 16] for i in range(at[row], at[row + 1], 16)}
            left = [line for line in split if digest(line, least_chars) not in own] if own else split
            n_lines.append(len(split))
            n_dropped.append(len(split) - len(left))
            kept.append("\n".join(left))
        return {"n_lines": n_lines, "n_dropped": n_dropped, "kept_text": kept}

    done = map_text(joined, "t", fields, run, keep=[*carried, "gone"]).drop("gone")
    return done.select(*[F.col(f"c{names.index(c)}").alias(c) for c in stay], "n_lines", "n_dropped", "kept_text")

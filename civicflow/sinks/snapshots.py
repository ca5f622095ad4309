"""Snapshot tables: immutable data folders, a list of them for each version, many writers.

A commit writes its rows to a fresh folder ``<path>/c=<id>`` and then creates
``<path>/_versions/<n>``, which names the data folders of version n.  That
file is created whole or not at all, and only if no file of the name is there:
of several writers that have read version n - 1 one creates it, on every store
(``publish``).  The others see a ``Conflict``: a merge whose partitions and
keys the other commit left alone goes on top of it as it is, any other change
is computed again on what is there now.  No version is lost and none is
overwritten; a job that dies before its file is created changes nothing.

A table can be divided in two ways:

* ``partitions`` maps a partition column to the expression that derives it
  from a row (``{"date": lambda: F.to_date("ts")}``): an update that moves a
  row moves it to its new partition, and readers prune whole partitions;
* ``buckets`` names the key columns by whose hash rows are dealt.  A bucket is
  a prefix of the hash's bits.  One that outgrows ``bucket_rows`` is divided
  by further bits when it is next rewritten, so buckets stay of one size as
  the table grows.  Their files are sorted by key and have a Bloom filter of it.

``merge`` rewrites only the partitions or buckets that a batch touches and
shares the folders of all others with the version before.  It also holds the
table's constraints: rows of the batch with a NULL in a column that may have
none, all but one of several with one key, and rows that would repeat a
``unique`` value are written to ``<path>/_quarantine`` with the rule, and the
others are merged.

A version also records the last epoch of each stream that wrote it
(``done``): an epoch that is played again makes no version.

The last ``KEEP_VERSIONS`` versions stay readable; folders that none of
them names are deleted.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left
from collections.abc import Callable
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators import constraints as C
from civicflow.operators.upsert import broadcastable, empty, written_and_measured
from civicflow.sinks.tables import MAX_RECORDS_PER_FILE, hadoop_fs

# versions of a snapshot that stay readable
KEEP_VERSIONS = 10
# rows of a bucket beyond which it is divided
BUCKET_ROWS = 1_000_000
# commits that are tried again after others' commits
ATTEMPTS = 20
_BUCKET = "bucket"
_DONE = "#done "
# fixed values: stores on which a rename fails if its target exists, as one step
RENAMING = ("hdfs", "viewfs", "webhdfs")
# fixed value: stores with links, which cannot be made over a file
LINKING = ("file",)


class Conflict(RuntimeError):
    """Another writer's version came first."""


class Version(NamedTuple):
    number: int
    folders: list[str]
    done: dict[str, int]


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Creates the file ``path`` with ``text``, whole, in one step; False if it exists.

    A link to a written file on local stores, a rename on those where it
    fails if the target exists, else one conditional put at the stream's end.
    """
    fs, final, jvm = hadoop_fs(spark, path)
    scheme = fs.getUri().getScheme() or "file"

    def write(stream) -> None:
        stream.write(bytearray(text.encode()))
        stream.close()

    if scheme not in LINKING + RENAMING:
        try:
            write(fs.createFile(final).overwrite(False).recursive().opt("fs.option.create.conditional.overwrite", True).build())
            return True
        except Exception as e:  # noqa: BLE001 - the reason is told by whether the file is there
            if fs.exists(final):
                return False
            raise e
    fs.mkdirs(final.getParent())
    temporary = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    write(fs.create(temporary, False))
    try:
        if scheme in RENAMING:
            return not fs.exists(final) and fs.rename(temporary, final)
        paths = jvm.java.nio.file.Paths
        no_more = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)
        old, new = (paths.get(fs.resolvePath(temporary).toUri().getPath(), no_more),
                    paths.get(fs.resolvePath(final.getParent()).toUri().getPath() + "/" + final.getName(), no_more))
        try:
            jvm.java.nio.file.Files.createLink(new, old)
            return True
        except Exception:  # noqa: BLE001 - the reason is told by whether the file is there
            if fs.exists(final):
                return False
            raise
    finally:
        fs.delete(temporary, False)


def cover(prefixes: list[str]) -> list[str]:
    """Prefixes of bits that meet every hash once: the given ones, and for hashes without one the shortest that fits."""
    have = sorted(prefixes)

    def fill(p: str) -> list[str]:
        at = bisect_left(have, p)
        if at == len(have) or not have[at].startswith(p) or have[at] == p:
            return [p]
        return fill(p + "0") + fill(p + "1")

    return fill("")


class Snapshot:
    """A versioned table below ``path``; see the module."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 partitions: dict[str, Callable[[], Column]] | None = None, buckets: list[str] | None = None,
                 bucket_rows: int = BUCKET_ROWS, unique: list[list[str]] | None = None):
        if partitions and buckets:
            raise ValueError("a table has partitions or buckets")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.partitions, self.buckets, self.bucket_rows = dict(partitions or {}), list(buckets or []), bucket_rows
        self.unique = list(unique or [])

    # ------------------------------------------------------------------ versions

    def _file(self, *parts: str):
        return hadoop_fs(self.spark, "/".join([self.path, *parts]))

    def _children(self, *parts: str) -> list[str]:
        fs, p, _ = self._file(*parts)
        return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        return sorted(int(name) for name in self._children("_versions") if name.isdigit())

    def version(self, number: int | None = None) -> Version:
        """A version, the current one unless given; number 0 if there is none."""
        if number is None:
            number = max(self.versions(), default=0)
        if not number:
            return Version(0, [], {})
        fs, p, jvm = self._file("_versions", str(number))
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
        folders, done = [], {}
        while (line := lines.readLine()) is not None:
            if line.startswith(_DONE):
                name, epoch = line.removeprefix(_DONE).rsplit(" ", 1)
                done[name] = int(epoch)
            else:
                folders.append(line)
        lines.close()
        return Version(number, folders, done)

    def folders(self, version: int) -> list[str]:
        """Data folders of a version, below the table's path."""
        return self.version(version).folders

    # ------------------------------------------------------------------ rows

    def _columns(self) -> list[str]:
        return list(self.partitions) or ([_BUCKET] if self.buckets else [])

    def _bits(self) -> Column:
        return F.lpad(F.bin(F.xxhash64(*self.buckets)), 64, "0")

    def _bucket(self, prefixes: list[str]) -> Column:
        """The bucket of a row among prefixes that meet every hash once."""
        by_length: dict[int, list[str]] = {}
        for p in prefixes:
            by_length.setdefault(len(p), []).append(p)
        *short, last = sorted(by_length)
        bits = self._bits()
        out = F.substring(bits, 1, last)
        for n in reversed(short):
            out = F.when(F.substring(bits, 1, n).isin(by_length[n]), F.substring(bits, 1, n)).otherwise(out)
        return F.concat(F.lit("r"), out)

    def _prefixes(self, folders: list[str]) -> list[str]:
        return cover([f.rsplit(f"/{_BUCKET}=r", 1)[1] for f in folders])

    def _with_partitions(self, df: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
        extra = [expr().alias(name) for name, expr in self.partitions.items()]
        if self.buckets:
            extra = [self._bucket(prefixes or [""]).alias(_BUCKET)]
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in self.schema.fields], *extra)

    def _read(self, folders: list[str], with_bucket: bool = False) -> DataFrame:
        none = self._with_partitions(empty(self.spark, self.schema))
        names = [c for c in none.columns if with_bucket or not (self.buckets and c == _BUCKET)]
        if not folders:
            return none.select(*names)
        df = (self.spark.read.schema(T.StructType([none.schema[c] for c in none.columns])).option("basePath", self.path)
              .parquet(*[f"{self.path}/{f}" for f in folders]))
        return df.select(*names)

    def read(self) -> DataFrame:
        """The current version: the table's columns, then its partition columns."""
        return self._read(self.version().folders)

    def find(self, *keys) -> DataFrame:
        """The rows with these values of a one-column key: of a bucketed table only the buckets that can hold them are read."""
        folders = self.version().folders
        name = self.buckets[0]
        if folders and keys:
            wanted = self.spark.range(1).select(F.explode(F.array(*[F.lit(k).cast(self.schema[name].dataType) for k in keys])).alias(name))
            names = {r[0] for r in wanted.select(self._bucket(self._prefixes(folders))).distinct().collect()}
            folders = [f for f in folders if f.rsplit("=", 1)[1] in names]
        return self._read(folders).filter(F.col(name).isin(list(keys)))

    # ------------------------------------------------------------------ commits

    def _write(self, df: DataFrame, prefixes: list[str] | None = None) -> list[str]:
        """The rows in a fresh folder; its data folders."""
        out = self._with_partitions(df, prefixes)
        name = f"c={uuid.uuid4().hex}"
        columns = self._columns()
        if columns:
            out = out.hint("rebalance", *columns)
        if self.buckets:
            out = out.sortWithinPartitions(_BUCKET, *self.buckets)
        writer = (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
                  .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE))
        for key in self.buckets:
            writer = (writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
                      .option(f"parquet.bloom.filter.expected.ndv#{key}", str(self.bucket_rows)))
        if columns:
            writer = writer.partitionBy(*columns)
        writer.parquet(f"{self.path}/{name}")
        new = [name]
        for _ in columns:
            new = [f"{folder}/{child}" for folder in new for child in self._children(folder) if "=" in child]
        return new

    def _delete(self, folders: list[str]) -> None:
        """Data folders that no version names."""
        for folder in {f.split("/", 1)[0] for f in folders}:
            fs, p, _ = self._file(folder)
            fs.delete(p, True)

    def _publish(self, new: list[str], kept: list[str], now: Version, done: tuple[str, int] | None) -> int:
        """Version ``now`` + 1; a Conflict if there is one."""
        marks = now.done | ({done[0]: done[1]} if done else {})
        text = "".join(f"{f}\n" for f in [*kept, *new]) + "".join(f"{_DONE}{k} {v}\n" for k, v in sorted(marks.items()))
        n = now.number + 1
        if not publish(self.spark, f"{self.path}/_versions/{n}", text):
            raise Conflict(f"version {n} of {self.path} was written by another job")
        self._prune()
        return n

    def commit(self, df: DataFrame) -> int:
        """A new version that holds the rows of ``df`` and nothing else, whatever was there."""
        new = self._write(df)
        for _ in range(ATTEMPTS):
            try:
                return self._publish(new, [], self.version(), None)
            except Conflict:
                continue
        self._delete(new)
        raise Conflict(f"{self.path} changes too often")

    def update(self, change: Callable[[DataFrame], DataFrame], done: tuple[str, int] | None = None) -> int:
        """A new version ``change(current rows)``, computed again if another version came first."""
        for _ in range(ATTEMPTS):
            now = self.version()
            if done and now.done.get(done[0], -1) >= done[1]:
                return now.number
            new = self._write(change(self._read(now.folders)), self._prefixes(now.folders) if self.buckets and now.folders else None)
            try:
                return self._publish(new, [], now, done)
            except Conflict:
                self._delete(new)
        raise Conflict(f"{self.path} changes too often")

    def _touched(self, now: Version, batch: DataFrame, small: bool, key: list[str]) -> tuple[set[str], list[str] | None]:
        """The last parts of the folders that a batch touches, and the prefixes that its rows are written by."""
        if self.buckets:
            prefixes = self._prefixes(now.folders)
            # a short text and a count for each bucket
            counts = {r[0][1:]: r[1] for r in batch.groupBy(self._bucket(prefixes)).count().collect()}
            folders = [f for f in now.folders if f.rsplit("=r", 1)[1] in counts]
            held = {r[0][1:]: r[1] for r in self._read(folders, True).groupBy(_BUCKET).count().collect()} if folders else {}
            grown = []
            for p in prefixes:
                rows = counts.get(p, 0) + held.get(p, 0) if p in counts else 0
                more = max(0, math.ceil(math.log2(rows / self.bucket_rows))) if rows else 0
                grown += [p + format(i, f"0{more}b") for i in range(1 << more)] if more else [p]
            return {f"{_BUCKET}=r{p}" for p in counts}, grown
        (name, expr), = self.partitions.items()
        new = batch.select(expr().cast("string").alias("p"))
        keys = batch.select(*key)
        old = (self._read(now.folders).select(*key, F.col(name).cast("string").alias("p"))
               .join(F.broadcast(keys) if small else keys, key, "left_semi").select("p"))
        # one short text for each partition
        touched = {r["p"] for r in new.unionByName(old).distinct().collect()}
        return {f"{name}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for v in touched}, None

    def _checked(self, batch: DataFrame, key: list[str]) -> DataFrame:
        """The rows of a written batch that the constraints allow; the others go to quarantine."""
        required = [f.name for f in self.schema.fields if not f.nullable and f.name in batch.columns]
        keys = [key, *[u for u in self.unique if set(u) <= set(batch.columns) and u != key]]
        current = self.version().folders
        # values that the table has under other keys, which the batch leaves as they are
        taken = {tuple(u): self._read(current).select(*key, *u).join(batch.select(*key), key, "left_anti").select(*u).distinct()
                 for u in keys[1:] if current}
        if not C.violated(batch, required, keys, taken):
            return batch
        rows, _, _ = written_and_measured(C.numbered(batch))
        good, bad = C.split(rows, required, keys, taken)
        (bad.withColumn("at", F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz"))
         .write.mode("append").parquet(f"{self.path}/_quarantine"))
        return good.select(*batch.columns)

    def quarantined(self) -> DataFrame:
        """(rule, row, at): rows that merges refused, as JSON text."""
        fs, p, _ = self._file("_quarantine")
        schema = "rule string, row string, at timestamp_ntz"
        if not fs.exists(p):
            return empty(self.spark, T.StructType.fromDDL(schema))
        return self.spark.read.schema(schema).parquet(f"{self.path}/_quarantine")

    def merge(self, batch: DataFrame, key: list[str], upsert: Callable[[DataFrame, DataFrame], DataFrame],
              done: tuple[str, int] | None = None) -> int:
        """Commit ``upsert(current rows, batch)``, rewriting only the partitions or buckets that the batch touches.

        Touched are the partitions of the batch's rows, and those that hold
        rows with its keys now: found with the key and partition columns only.
        Keys of a bucketed table are in the buckets of the batch.
        """
        batch, rows, size = written_and_measured(batch)
        checked = self._checked(batch, key)
        if checked is not batch:
            batch, rows, size = written_and_measured(checked)
        if not self.buckets and len(self.partitions) != 1:
            return self.update(lambda current: upsert(current, batch), done)
        small = broadcastable(rows, size)
        for attempt in range(ATTEMPTS):
            now = self.version()
            if done and now.done.get(done[0], -1) >= done[1]:
                return now.number
            if attempt and self.unique:
                # what came in between may hold values that were free before
                checked = self._checked(batch, key)
                batch = checked if checked is batch else written_and_measured(checked)[0]
            touched, prefixes = self._touched(now, batch, small, key)
            rewritten = [f for f in now.folders if f.rsplit("/", 1)[-1] in touched]
            new = self._write(upsert(self._read(rewritten), batch), prefixes)
            base = now
            while base is not None:
                try:
                    return self._publish(new, [f for f in base.folders if f not in set(rewritten)], base, done)
                except Conflict:
                    base = self._beside(base, touched, rewritten, batch, small, key)
            self._delete(new)
        raise Conflict(f"{self.path} changes too often")

    def _beside(self, base: Version, touched: set[str], rewritten: list[str], batch: DataFrame, small: bool,
                key: list[str]) -> Version | None:
        """The current version, if what came after ``base`` left the partitions and keys of this merge alone."""
        now = self.version()
        theirs = [f for f in now.folders if f not in set(base.folders)]
        if not set(rewritten) <= set(now.folders) or (theirs and self.unique):
            return None
        last = {f.rsplit("/", 1)[-1] for f in theirs}
        if self.buckets:
            # a bucket inside or around one of ours is ours
            mine = {t.rsplit("=r", 1)[1] for t in touched}
            other = {t.rsplit("=r", 1)[1] for t in last}
            if any(a.startswith(b) or b.startswith(a) for a in mine for b in other):
                return None
        elif last & touched:
            return None
        elif theirs:
            keys = batch.select(*key)
            if not self._read(theirs).select(*key).join(F.broadcast(keys) if small else keys, key, "left_semi").isEmpty():
                return None
        return now

    def _prune(self) -> None:
        vs = self.versions()
        if len(vs) <= KEEP_VERSIONS:
            return
        fs, _, _ = self._file()
        used = {f for v in vs[-KEEP_VERSIONS:] for f in self.folders(v)}
        gone = {f for v in vs[:-KEEP_VERSIONS] for f in self.folders(v)} - used
        for v in vs[:-KEEP_VERSIONS]:
            fs.delete(self._file("_versions", str(v))[1], False)
        for folder in gone:
            fs.delete(self._file(folder)[1], True)

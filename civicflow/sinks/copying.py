"""Copies of files by tasks: a data source writer whose rows are files to copy.

Each row (from_scheme, from_authority, from_path, name, size) is one file; the
task that gets it streams the bytes from store to store in pieces of
``PIECE`` and holds no more than one.  It writes to a name of its own attempt,
so a task that is killed, retried or run twice at once leaves only a file that
nobody asks for.  The commit message of a task names what it copied, with
lengths and checksums; the commit, which moves names and no bytes, gives the
copies their names below the target folder and fails unless every file is
there once and whole.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from civicflow.stores import Located, opened

NAME = "civicflow_files"
PIECE = 8 << 20
SCHEMA = "from_scheme string, from_authority string, from_path string, name string, size long"
# fixed value: folder of the attempts below the target folder
ATTEMPTS = "_attempts"

# tasks need no copy of the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Copied(WriterCommitMessage):
    """(path of the attempt, name, bytes, crc32) of each file."""

    files: list[tuple[str, str, int, int]]


class FileWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.scheme, self.authority = options["scheme"], options["authority"]
        self.folder, self.files = options["folder"], int(options["files"])

    def _target(self):
        store, prefix = opened(self.scheme, self.authority)
        return store, prefix + self.folder

    def stream(self, source, target) -> tuple[int, int]:
        """Copies piece by piece; returns the bytes and their crc32."""
        size, crc = 0, 0
        while piece := source.read(PIECE):
            target.write(piece)
            size, crc = size + len(piece), zlib.crc32(piece, crc)
        return size, crc

    def write(self, iterator: Iterator) -> Copied:
        store, folder = self._target()
        attempt = f"{folder}/{ATTEMPTS}/{uuid.uuid4().hex}"
        store.create_dir(attempt, recursive=True)
        done = []
        for row in iterator:
            origin, prefix = opened(row.from_scheme, row.from_authority)
            path = f"{attempt}/{len(done)}"
            with (origin.open_input_stream(prefix + row.from_path, compression=None) as source,
                  store.open_output_stream(path, compression=None) as target):
                size, crc = self.stream(source, target)
            if size != row.size:
                raise OSError(f"{row.from_path} had {row.size} bytes and gave {size}: it changed while it was copied")
            done.append((path, row.name, size, crc))
        return Copied(done)

    def commit(self, messages: list) -> None:
        store, folder = self._target()
        copied = [file for message in messages if message for file in message.files]
        if sorted({name for _, name, _, _ in copied}) != sorted(name for _, name, _, _ in copied) or len(copied) != self.files:
            raise OSError(f"{len(copied)} copies of {self.files} files")
        for path, name, _, _ in copied:
            final = f"{folder}/{name}"
            store.create_dir(final.rsplit("/", 1)[0], recursive=True)
            store.move(path, final)
        store.delete_dir(f"{folder}/{ATTEMPTS}")

    def abort(self, messages: list) -> None:
        store, folder = self._target()
        store.delete_dir_contents(f"{folder}/{ATTEMPTS}", missing_dir_ok=True)


class FileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options)


def copy_files(spark: SparkSession, files: list[tuple[Located, str, int]], folder: Located, sink: type[DataSource] = FileSink) -> None:
    """Copies (place, name, size) to ``folder``/name; a task takes files of about the same size together."""
    if not files:
        return
    spark.dataSource.register(sink)
    tasks = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    # largest first, dealt round: names and sizes only
    ordered = sorted(files, key=lambda f: -f[2])
    dealt: DataFrame = spark.createDataFrame([(i % tasks, *place, name, size) for i, (place, name, size) in enumerate(ordered)],
                                             f"part int, {SCHEMA}")
    (dealt.repartitionByRange(tasks, "part").drop("part").write.format(sink.name()).mode("append")
     .option("scheme", folder.scheme).option("authority", folder.authority).option("folder", folder.path)
     .option("files", len(files)).save())

"""Sinks: partitioned clean files, reject logs, append tables.

All writes go through Spark's commit protocol: a job publishes its files
only when every task has succeeded, so a lost executor means a retried
task, never half a partition.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# bounded file size for every partitioned write
MAX_RECORDS_PER_FILE = 5_000_000


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite") -> None:
    """Hive-partitioned Parquet with dynamic partition overwrite (K2).

    ``rebalance`` on the partition columns sends each partition value to one
    writer (one file per directory), while AQE splits a value that holds a
    large share of the rows over several writers instead of one straggler.
    NULL partition values are the caller's to filter (Spark would write them
    to ``__HIVE_DEFAULT_PARTITION__``).
    """
    (df.hint("rebalance", *partition_cols)
     .write.mode(mode)
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(*partition_cols)
     .parquet(path))


def replace_days(df: DataFrame, path: str, days: list[str], partition_cols: list[str]) -> None:
    """Replace whole day folders: afterwards ``path/<first column>=<day>`` holds just the rows of ``df`` for it.

    ``partition_cols`` starts with the day.  The rows are written beside the
    table and each day's folder takes its place when all are written, so a
    rerun with fewer rows (or none) leaves nothing of the earlier run behind,
    and a failed write leaves the table as it was.
    """
    spark = df.sparkSession
    fs, root, jvm = hadoop_fs(spark, path.rstrip("/"))
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    try:
        (df.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*partition_cols).parquet(staging))
        swap_folders(fs, jvm, {f"{path.rstrip('/')}/{partition_cols[0]}={day}": f"{staging}/{partition_cols[0]}={day}" for day in days})
    finally:
        fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)


def swap_folders(fs, jvm, swaps: dict[str, str]) -> None:
    """Each folder gives way to the one named for it (to none if that one is not there).

    The old folders are first renamed aside, then the new ones in, and only
    then are the old ones deleted.  If a rename fails, what was done is undone
    and the folders are as they were.  A process that dies in between leaves
    an old folder under a hidden name beside its own, with ``_aside-`` in
    front; the next swap of that folder puts it back first if its own name is
    free, and deletes it otherwise.
    """
    path = jvm.org.apache.hadoop.fs.Path
    done: list[tuple] = []
    asides = []

    def rename(old, new) -> None:
        if not fs.rename(old, new):
            raise OSError(f"rename failed: {old.toString()}")
        done.append((old, new))

    def aside_of(folder) -> object:
        return path(folder.getParent(), f"_aside-{folder.getName()}")

    for target in swaps:
        folder = path(target)
        aside = aside_of(folder)
        if fs.exists(aside):
            # an earlier swap died: after its first step the folder is missing, after its second it is the new one
            if fs.exists(folder):
                fs.delete(aside, True)
            elif not fs.rename(aside, folder):
                raise OSError(f"rename failed: {aside.toString()}")
    try:
        for target, new in swaps.items():
            folder = path(target)
            fs.mkdirs(folder.getParent())
            if fs.exists(folder):
                rename(folder, aside_of(folder))
                asides.append(aside_of(folder))
            if fs.exists(path(new)):
                rename(path(new), folder)
    except BaseException:
        for old, new in reversed(done):
            fs.rename(new, old)
        raise
    for aside in asides:
        fs.delete(aside, True)


def append(df: DataFrame, path: str) -> None:
    """K3: ``if_exists='append'``."""
    df.write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path, jvm) for a path on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm

"""Intermediate tables in the cluster's shared folder, and values sent to its workers."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from contextlib import contextmanager
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from civicflow import session

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession):
    """Actions inside drop their shuffle files when they end: their results are in written tables."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str, partitions: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in a fresh folder under ``spark.checkpoint.dir``: lineage ends there."""
    spark = df.sparkSession
    folder = session.scratch(spark, name)
    with released_shuffles(spark):
        df.write.partitionBy(*partitions or []).option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """``value`` broadcast to the workers, as a function that gives it there.

    A plain broadcast pickles objects by the names of their classes, which
    workers can only load with this package on their path.  Here classes of
    this subpackage travel with the value, as its functions do.  A worker
    unpacks it once and keeps it with the broadcast, for all its tasks and as
    long as Spark keeps the broadcast there; the packed bytes go.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get() -> Any:
        if not hasattr(packed, "_unpacked"):
            packed._unpacked = pickle.loads(packed.value)
            if getattr(packed, "_sc", None) is None and getattr(packed, "_path", None) and hasattr(packed, "_value"):
                del packed._value
        return packed._unpacked

    return get

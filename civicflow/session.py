"""Spark session settings the engine relies on.

Every job works in UTC, overwrites partitions dynamically and lets AQE
re-plan shuffles at runtime.  ``configure`` only touches runtime SQL
settings, so it is safe to call on a session someone else built (the
driver, a notebook, a cluster job).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings applied to any session handed to the engine.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's join even when a following aggregation would have
    # reused the join's partitioning (it shuffles its partial sums instead)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a JSON object with a repeated key keeps the last value, as a
    # Python dict does, instead of turning the whole file NULL
    "spark.sql.variant.allowDuplicateKeys": "true",
    # folders are listed by tasks that take many each, not by a task a folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(master: str | None = None, app: str = "civicflow", shuffle_partitions: int | None = None,
          extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster the session comes from spark-submit; only ``configure`` is
    applied there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("CIVICFLOW_DRIVER_MEMORY", "8g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **RUNTIME_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Lineage cuts and intermediate tables go there.  Only a local-mode
    session that names none (tests, the bench) gets a private folder; on a
    cluster the setting is required.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a random sub-folder; use its parent
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        # executors on other machines could not see a local folder
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage (HDFS, S3A, ...)")
    local = tempfile.mkdtemp(prefix="civicflow-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared dir for one job run."""
    return f"{shared_dir(spark)}/civicflow/{name}-{uuid.uuid4().hex[:12]}"

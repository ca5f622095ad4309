"""Spread CPU-heavy row work over the cluster when input splits are few.

A scan gives one task per file split.  A few large files (one whole-text
JSON file per task, a table stored as one row group) would run the heavy
per-row projections that follow on a handful of cores.  ``spread``
round-robins such an input over ``defaultParallelism`` partitions first, but
only when it would keep fewer than a quarter of the cores busy: beyond that a
shuffle of the whole input costs more than it gains.  Round-robin
repartitioning sorts before distributing, so a retried task after an executor
loss gets the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


# bytes of a stored table that are one task's share of heavy row work
DEAL_BYTES = 2 << 20
# operators whose partitioning is not the scan's, or that would have to run to be inspected
_SHUFFLING = ("Exchange", "Join", "Aggregate", "Window", "Sort", "Subquery", "AdaptiveSparkPlan")
# a scan with this share of the cores is left as it is
ENOUGH = 4


def _operators(plan) -> list[str]:
    children = plan.children()
    return [plan.nodeName(), *(n for i in range(children.size()) for n in _operators(children.apply(i)))]


def input_partitions(df: DataFrame) -> int | None:
    """Partitions of a scan-and-project plan, from planning only.

    ``None`` for a plan with a shuffle, join or aggregate (told by its
    operators, not by its text): asking such a plan for its partitions could
    run its stages, and its partitioning is the shuffle's anyway.
    """
    plan = df._jdf.queryExecution().executedPlan()
    if any(word in name for name in _operators(plan) for word in _SHUFFLING):
        return None
    return plan.execute().getNumPartitions()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    n = input_partitions(df)
    return df.repartition(target) if n is not None and n * ENOUGH <= target else df


def dealt(df: DataFrame) -> DataFrame:
    """The rows of a stored table, dealt evenly over as many tasks as its size asks for, at least one a core.

    For heavy work on narrow rows, which costs far more than their shuffle.
    The splits of a Parquet file say little about its rows: a row group lies
    whole in one of them and leaves others empty, so a file may have as many
    splits as there are cores and one busy task.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // DEAL_BYTES)))

"""Sums that stay current with a snapshot table, brought up to date by what changed.

A version of a snapshot is a list of immutable folders.  Between two versions
some folders go and some come; every row that changed is in one of them, and a
row that only moved along with its partition is in both.  So sums by group
change by the sums of the new folders less those of the gone ones, whatever
the batches between the versions did, in whatever order: corrected values are
retracted, moved rows leave their old group.  A refresh reads only these
folders and rewrites only the groups' partitions that change.

The rollup records the version it has reached, in the commit that reaches it:
a refresh that dies changes nothing, and one that is repeated has nothing to
do.  If the version it has reached is no longer kept, it is computed anew.

Sums are exact (whole numbers or decimals), so retracting leaves no residue.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.sinks.snapshots import Snapshot

_SOURCE = "source"


class Rollup:
    """``measures`` summed over the rows of ``source`` by ``keys``; both map names to (type, column of a source row).

    ``rows`` counts the rows of a group, which is dropped when it has none.
    The table is divided by hash buckets of the keys.
    """

    def __init__(self, source: Snapshot, path: str, keys: Mapping[str, tuple[T.DataType, Callable[[], Column]]],
                 measures: Mapping[str, tuple[T.DataType, Callable[[], Column]]], **options):
        self.source, self.keys, self.measures = source, dict(keys), dict(measures)
        fields = [T.StructField(k, kind) for k, (kind, _) in self.keys.items()]
        fields += [T.StructField(m, kind) for m, (kind, _) in self.measures.items()] + [T.StructField("rows", T.LongType())]
        self.table = Snapshot(source.spark, path, T.StructType(fields), buckets=list(self.keys), **options)

    def sums(self, rows: DataFrame) -> DataFrame:
        """The groups of source rows."""
        keyed = rows.select(*[c().cast(kind).alias(k) for k, (kind, c) in self.keys.items()],
                            *[c().cast(kind).alias(m) for m, (kind, c) in self.measures.items()], F.lit(1).cast("long").alias("rows"))
        return self._added(keyed)

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).cast(kind).alias(m) for m, (kind, _) in self.measures.items()],
                                            F.sum("rows").alias("rows"))

    def read(self) -> DataFrame:
        return self.table.read()

    def reached(self) -> int:
        """The source's version that the sums are of."""
        return self.table.version().done.get(_SOURCE, 0)

    def refresh(self) -> int:
        """Bring the sums to the source's current version; returns it."""
        now, last = self.source.version(), self.reached()
        if now.number == last:
            return last
        if last and last not in self.source.versions():
            self.table.update(lambda _: self.sums(self.source._read(now.folders)), (_SOURCE, now.number))
            return now.number
        before = self.source.folders(last) if last else []
        came = self.sums(self.source._read([f for f in now.folders if f not in set(before)]))
        went = self.sums(self.source._read([f for f in before if f not in set(now.folders)]))
        minus = went.select(*self.keys, *[(-F.col(m)).alias(m) for m in [*self.measures, "rows"]])
        change = self._added(came.unionByName(minus)).where(" or ".join(f"`{m}` <> 0" for m in [*self.measures, "rows"]))

        def apply(current: DataFrame, batch: DataFrame) -> DataFrame:
            return self._added(current.unionByName(batch)).where("rows <> 0")

        # groups of NULL keys are groups too: the batch holds each key once, with or without NULLs
        self.table.merge(change, list(self.keys), apply, (_SOURCE, now.number))
        return now.number

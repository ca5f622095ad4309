"""Keyed upsert on immutable snapshots (``INSERT … ON CONFLICT DO UPDATE``).

Parquet has no MERGE, so an upsert computes the next snapshot from the
current one and a batch that is unique on the key.  Two plans:

* **broadcast** (batch row count checked under ``broadcast_max_rows``): the
  target is joined, left outer, with the broadcast batch, and the keys that
  are new are found by a semi-join of the target with the broadcast batch
  keys.  The target is streamed twice and never shuffled — the daily case
  of a small batch against a large table.
* **shuffle**: one full outer join on the key (both sides hash-partitioned;
  a snapshot written bucketed on the key joins without moving the target).

``keep_last`` deduplicates a batch with ``max_by`` over a packed row:
partial aggregation runs before the shuffle, so a key holding a third of
the batch collapses to one row per task instead of one giant group.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.session import scratch

_PRESENT = "_present"
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# bytes that a field's place in a row takes beside its value, at most
FIELD_BYTES = 16
# rows and bytes of the tables that were written to be measured, so that none is written twice
_MEASURED: WeakKeyDictionary[DataFrame, tuple[int, int]] = WeakKeyDictionary()


def written_and_measured(df: DataFrame) -> tuple[DataFrame, int, int]:
    """``df`` as a Parquet table in the shared folder, with its rows and a bound of its bytes in memory.

    Written plain (no dictionary, no compression), a value takes its own
    bytes in the file; in memory it takes at most twice that, and a null or
    a field's place ``FIELD_BYTES`` more.
    """
    if df in _MEASURED:
        return (df, *_MEASURED[df])
    spark = df.sparkSession
    folder = scratch(spark, "batch")
    df.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(folder)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    table = spark.read.schema(df.schema).parquet(folder)
    rows = table.count()
    _MEASURED[table] = rows, 2 * size + rows * FIELD_BYTES * (len(df.columns) + 1)
    return (table, *_MEASURED[table])


def broadcastable(rows: int, size: int, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    return rows <= max_rows and size <= max_bytes


def orderable_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns usable as a final tie-breaker (variant and map are not orderable)."""
    skip = set(exclude)
    bad = (T.VariantType, T.MapType)
    return [f.name for f in df.schema.fields if f.name not in skip and not isinstance(f.dataType, bad)]


def keep_last(df: DataFrame, key: list[str], order: list[Column | str], tie_break_all: bool = True) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (D1, K4 dedupe).

    With ``tie_break_all`` every orderable column is appended to the order,
    so the choice is deterministic even for exact duplicates.  The key
    columns come from the grouping itself, so the result stays
    hash-partitioned on the key and a following join on it needs no shuffle.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if tie_break_all:
        order_cols += [F.col(c) for c in orderable_columns(df, key)]
    ordering = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order_cols)])
    rest = [c for c in df.columns if c not in key]
    packed = F.struct(*[F.col(c) for c in rest])
    picked = df.groupBy(*key).agg(F.max_by(packed, ordering).alias("_row"))
    return picked.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def _merged_columns(target: DataFrame, batch: DataFrame, key: list[str], replace: set[str],
                    defaults: Mapping[str, Column], in_t: Column, in_b: Column) -> list[Column]:
    out = []
    for f in target.schema.fields:
        c = f.name
        tv = F.col(f"t.{c}")
        bv = F.col(f"b.{c}") if c in batch.columns else defaults.get(c, F.lit(None)).cast(f.dataType)
        if c in key:
            value = F.coalesce(tv, bv)
        elif c in replace:
            value = F.when(in_b, bv).otherwise(tv)
        else:
            value = F.when(in_t, tv).otherwise(bv)
        out.append(value.cast(f.dataType).alias(c, metadata=f.metadata))
    return out


def upsert(target: DataFrame, batch: DataFrame, key: list[str], replace: Iterable[str],
           insert_defaults: Mapping[str, Column] | None = None, strategy: str = "auto",
           broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
           broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Next snapshot of ``target`` after upserting ``batch`` (unique on ``key``).

    * key not in target → the batch row is inserted; target columns the batch
      does not carry take ``insert_defaults`` (SQL column defaults) or NULL;
    * key in both → columns in ``replace`` take the batch value (NULLs
      included, as ``EXCLUDED.col`` does); every other column is kept.

    ``strategy`` is ``"broadcast"``, ``"shuffle"`` or ``"auto"`` (write the
    batch once, take its size from the files and broadcast only under both
    ``broadcast_max_rows`` and ``broadcast_max_bytes``).
    """
    replace = set(replace)
    defaults = dict(insert_defaults or {})
    if strategy == "auto":
        # the batch is computed once; its table in the shared folder survives executor loss
        batch, rows, size = written_and_measured(batch)
        strategy = "broadcast" if broadcastable(rows, size, broadcast_max_rows, broadcast_max_bytes) else "shuffle"
    t = target.withColumn(_PRESENT, F.lit(True)).alias("t")
    b = batch.withColumn(_PRESENT, F.lit(True)).alias("b")
    cond = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in key]
    in_t, in_b = F.col(f"t.{_PRESENT}").isNotNull(), F.col(f"b.{_PRESENT}").isNotNull()
    if strategy == "shuffle":
        joined = t.join(b, cond, "full_outer")
        return joined.select(*_merged_columns(target, batch, key, replace, defaults, in_t, in_b))
    if strategy != "broadcast":
        raise ValueError(f"unknown upsert strategy {strategy!r}")
    kept_or_updated = t.join(F.broadcast(b), cond, "left_outer").select(
        *_merged_columns(target, batch, key, replace, defaults, in_t, in_b))
    existing = target.select(*key).join(F.broadcast(batch.select(*key)), key, "left_semi")
    new_rows = batch.join(existing, key, "left_anti").withColumn(_PRESENT, F.lit(True)).alias("b")
    inserted = new_rows.select(*[
        (F.col(f"b.{f.name}") if f.name in batch.columns else defaults.get(f.name, F.lit(None)))
        .cast(f.dataType).alias(f.name, metadata=f.metadata) for f in target.schema.fields])
    return kept_or_updated.unionByName(inserted)


def empty(spark, schema: T.StructType) -> DataFrame:
    """An empty table of ``schema`` built in the JVM (no Python-side rows)."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields])

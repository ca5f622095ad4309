"""Citizen reports: normalise, deduplicate, upsert, search.

The reference parses each document in a Python loop; here a batch of
variant documents goes through narrow projections (``functions.reports``),
one shuffle on ``external_id`` to keep the last version of each report, and
the keyed upsert (``operators.upsert``): a broadcast of the measured batch
when it is small, so the current table is not shuffled, a full outer join
otherwise.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.functions import reports as R
from civicflow.functions.dates import normalize_date
from civicflow.functions.geo import SRID_METADATA
from civicflow.operators import path_index
from civicflow.operators.upsert import broadcastable, empty, keep_last, upsert, written_and_measured
from civicflow.schemas import CITIZEN_REPORTS
from civicflow.sinks.snapshots import Snapshot

REPORT_KEY = ["external_id"]
# columns a re-sent report replaces; ingested_at is kept from the first insert
REPORT_REPLACED = ("source_timestamp", "category", "commune", "quartier", "status", "geom", "original_doc")


def normalize(docs: DataFrame, doc_col: str = "doc", keep: tuple[str, ...] = ("file_key", "pos")) -> DataFrame:
    """Variant documents → unified columns (+ ``original_doc``).

    Three narrow projections (shape, fields, date) in one stage; each step
    reads the previous step's columns, so no test is evaluated twice.
    """
    d = F.col("original_doc")
    shaped = docs.select(*keep, F.col(doc_col).alias("original_doc"), R.shape(F.col(doc_col)).alias("shape"))
    fields = shaped.select(*keep, "shape", *R.field_columns(d, F.col("shape")), "original_doc")
    return fields.select(*keep, "shape", "external_id",
                         normalize_date(F.col("ts_value")).alias("source_timestamp"),
                         "category", "commune", "quartier", "status", "lat", "lon", "original_doc")


def dedupe(normalized: DataFrame, order: tuple[str, ...] = ("file_key", "pos")) -> DataFrame:
    """P11 + D1: drop reports without id, keep the last one per id.

    "Last" is the greatest (file, position): the later file wins, and within
    a file the later document.
    """
    with_id = normalized.where(F.col("external_id").isNotNull())
    return keep_last(with_id, REPORT_KEY, list(order), tie_break_all=False)


def processed_per_file(normalized: DataFrame) -> DataFrame:
    """Reports a load processes, file by file: the ids of each file, each once.

    An id in two files counts in both, as every file is upserted on its own.
    """
    return (normalized.where(F.col("external_id").isNotNull()).groupBy("file_key")
            .agg(F.count_distinct("external_id").alias("reports")))


def to_table_rows(deduped: DataFrame) -> DataFrame:
    """P10: the table's columns (point only when both coordinates exist)."""
    return deduped.select(
        "external_id", "source_timestamp", "category", "commune", "quartier", "status",
        R.point_of(F.col("lon"), F.col("lat")).alias("geom", metadata=SRID_METADATA), "original_doc")


def upsert_reports(table: DataFrame, batch_rows: DataFrame, ingested_at: Column) -> DataFrame:
    """K5: conflict on external_id; seven columns replaced (NULLs included);
    ``ingested_at`` set on insert and kept afterwards."""
    return upsert(table, batch_rows, REPORT_KEY, REPORT_REPLACED,
                  insert_defaults={"ingested_at": ingested_at})


def empty_table(spark) -> DataFrame:
    return empty(spark, CITIZEN_REPORTS)


def merge_reports(table: Snapshot, batch_rows: DataFrame, ingested_at: Column, index: Snapshot | None = None,
                  done: tuple[str, int] | None = None) -> int:
    """K5 into the bucketed table, and its path index along with it: postings of the new documents first, stale ones last."""
    change = partial(upsert_reports, ingested_at=ingested_at)
    if index is None:
        return table.merge(batch_rows, REPORT_KEY, change, done)
    batch_rows, rows, size = written_and_measured(batch_rows)
    keys = batch_rows.select(*REPORT_KEY)
    old = table.read().join(F.broadcast(keys) if broadcastable(rows, size) else keys, REPORT_KEY, "left_semi").select(*REPORT_KEY, "original_doc")
    # written: the documents as they are now, before the merge
    old, _, _ = written_and_measured(old)
    new = batch_rows.select(*REPORT_KEY, "original_doc")
    path_index.add(index, new, REPORT_KEY[0], "original_doc")
    version = table.merge(batch_rows, REPORT_KEY, change, done)
    path_index.drop(index, old, new, REPORT_KEY[0], "original_doc")
    return version


def search(table: DataFrame, path: str, value: str) -> DataFrame:
    """Reports whose original document has ``value`` at JSON ``path``."""
    return table.where(F.try_variant_get(F.col("original_doc"), path, "string") == F.lit(value))

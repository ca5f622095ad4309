"""Event file scans: bronze CSV (S2) and clean Parquet.

Both are split scans: a file is read by as many tasks as it has splits,
filters and column selections reach the Parquet reader, and the
``date=``/``category=`` directories prune partitions.
"""

from __future__ import annotations

import csv
import sys
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.schemas import CLEAN_EVENTS, CLEAN_FILE, RAW_CSV
from civicflow.sinks.tables import hadoop_fs
from civicflow.sources import csv_ranges
from civicflow.sources.ranges import large_files, listed, listing, split_bytes
from civicflow.stores import PLACE, SCHEMES, opened

# the tasks that read header lines need no copy of the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the path segment a category is read from when a file lacks it.
CATEGORY_IN_PATH = r"category=([^/]+)/"


def first_line(stream) -> str | None:
    """The first line of a byte stream; None if it has none."""
    text = b""
    while b"\n" not in text and b"\r" not in text and (part := stream.read(1 << 16)):
        text += part
    return text.splitlines()[0].decode("utf-8", "replace").removeprefix("\ufeff") if text else None


def csv_headers(spark: SparkSession, files: DataFrame) -> dict[str, list[str]]:
    """The CSV files of a listing by their header line; empty files are left out.

    Tasks read the first lines, a few KB of each file.  Of a store that tasks
    cannot open, Spark's text reader reads the files.
    """
    stores = [r[0] for r in files.select(F.regexp_extract("path", r"^([A-Za-z0-9+.-]+):", 1)).distinct().collect()]
    if all(scheme in SCHEMES for scheme in stores):
        def read(batches):
            for batch in batches:
                lines = []
                for path in batch.column(0).to_pylist():
                    scheme, authority, name = PLACE.match(path).groups()
                    store, prefix = opened(scheme, authority or "")
                    with store.open_input_stream(prefix + name) as stream:
                        lines.append(first_line(stream))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], names=["path", "header"])

        lines = files.filter("length > 0").select("path").mapInArrow(read, "path string, header string")
    else:
        names = [r["path"] for r in files.filter("length > 0").collect()]
        lines = (spark.read.text(names).select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"),
                                               F.col("_metadata.file_block_start").alias("start"))
                 .groupBy("path").agg(F.regexp_replace(F.min_by("value", F.struct("start", "at")), "^\ufeff", "").alias("header"))) if names else None
    if lines is None:
        return {}
    found = lines.filter("header is not null").groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return {r["header"]: r["paths"] for r in sorted(found, key=lambda r: r["paths"])}


def _named(header: str) -> list[str]:
    """Column names as Spark's reader gives them: those that occur twice, whatever their case, get their place behind them."""
    names = next(csv.reader([header]))
    twice = Counter(n.lower() for n in names)
    return [f"_c{i}" if not n else f"{n}{i}" if twice[n.lower()] > 1 else n for i, n in enumerate(names)]


def scan_csv(spark: SparkSession, path: str, ds: str | None = None, multi_line: bool = True, split: int | None = None) -> DataFrame:
    """Bronze CSV with a header; every field is text (typed later by checks).

    Every file is read under its own header (files with equal headers
    together), so exports with another column order or further columns can
    lie side by side; a missing column is NULL.  Fields are quoted as usual:
    doubled quotes, and line breaks inside quotes.

    A file of one split (of the session, or ``split`` bytes) is one task,
    streamed.  A larger one is read by many:
    split at any line end if no record of it spans lines, else by ranges that
    find where records begin (``csv_ranges``).  Compressed files, and ones
    whose header spans lines, stay with one task.  ``multi_line=False`` splits
    all files at line ends unseen.

    The header names the timestamp ``timestamp``; it is exposed as ``ts``.
    The landing day is the first ``date=`` folder of a file's path below
    ``path``, as ``ds``; with ``ds`` only that day's folder is listed and read.
    """
    folder = path.rstrip("/") + (f"/date={ds}" if ds else "")
    files = listing(spark, folder).filter("length > 0")
    large = large_files(files, split_bytes(spark) if split is None else split) if multi_line else []
    # (header, files, read by lines, records)
    groups: list[tuple[str, list[str], bool, DataFrame | None]] = []
    streamed: list[str] = []
    if large:
        seen = csv_ranges.profile(spark, large)
        name = {f: listed(f) for f in seen}
        quoted = [f for f, x in seen.items() if x["quotes"] and not x["odd"]]
        entry, opening = csv_ranges.entries(spark, [name[f] for f in quoted]) if quoted else ({}, set())
        by_kind: dict[tuple, list[str]] = {}
        for f, x in seen.items():
            if x["odd"]:
                streamed.append(name[f])
            else:
                lines = x["even"] and f not in opening
                by_kind.setdefault((x["header"], lines, x["crlf"]), []).append(f)
        for (header, lines, crlf), found in by_kind.items():
            paths = [name[f] for f in found]
            if not lines:
                # a file without quotes has no record of several lines, however its lines end
                need = [f for f in found if (f, 0) not in entry]
                known = entry | (csv_ranges.entries(spark, [name[f] for f in need])[0] if need else {})
                cut = csv_ranges.records(spark, paths, {k: v for k, v in known.items() if k[0] in set(found)}, crlf)
            groups.append((header, paths, lines, None if lines else cut))
    small = files.filter(~F.col("path").isin([f for f in large if f not in set(streamed)])) if large else files
    groups += [(header, paths, not multi_line, None) for header, paths in csv_headers(spark, small).items()]
    dated = ds is not None or any("/date=" in f for _, paths, _, _ in groups for f in paths)
    parts = []
    for header, paths, lines, cut in groups:
        if cut is None:
            df = (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
                  .option("quote", '"').option("escape", '"').option("multiLine", not lines).csv(paths))
            present = {c: F.col(f"`{c}`") for c in df.columns}
            file = F.col("_metadata.file_path")
        else:
            names = _named(header)
            kind = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
            df = cut.select("file", F.from_csv("record", kind.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                                               {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}).alias("r"))
            present = {n: F.col(f"r.c{i}") for i, n in enumerate(names)}
            file = F.col("file")
        cols = [present.get(f.name, F.lit(None)).cast("string").alias(f.name) for f in RAW_CSV.fields]
        if dated:
            cols.append(F.nullif(F.regexp_extract(file, r"/date=([^/]+)/", 1), F.lit("")).cast("date").alias("ds"))
        parts.append(df.select(*cols))
    if not parts:
        parts.append(spark.range(0).select(*[F.lit(None).cast("string").alias(f.name) for f in RAW_CSV.fields],
                                           *([F.lit(None).cast("date").alias("ds")] if dated else [])))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("timestamp", "ts")


def write_csv_export(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Events as a source system would export them: CSV text with a header.

    Timestamps are written with microseconds (Spark's CSV default keeps
    milliseconds only).
    """
    out = df.select(
        F.col("id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
        F.col("value").cast("string").alias("value"),
        "category", "source",
        *([F.date_format(partition_col, "yyyy-MM-dd").alias("date")] if partition_col else []))
    writer = out.write.mode("overwrite").option("header", True)
    if partition_col:
        writer = writer.partitionBy("date")
    writer.csv(path)


def scan_clean(spark: SparkSession, root: str) -> DataFrame:
    """Every clean Parquet file that the validation wrote under ``root`` (full history, S4).

    Landing day, date and category are partition directories and come from
    the path.  Files of other writers are for :func:`scan_foreign`.
    """
    # with a schema a category stays the text of its folder (007, 2024-01-01)
    return spark.read.schema(CLEAN_FILE).option("basePath", root).parquet(root)


def clean_folders(spark: SparkSession, root: str) -> tuple[list[str], list[str]]:
    """The folders and files at the top of a clean root: those of the validation, and those of others."""
    fs, path, _ = hadoop_fs(spark, root)
    names = [st.getPath() for st in fs.listStatus(path) if not st.getPath().getName().startswith(("_", "."))]
    own = [p.toString() for p in names if p.getName().startswith("ingest_ds=")]
    return own, [p.toString() for p in names if not p.getName().startswith("ingest_ds=")]


def _from_path(column: str, pattern: str):
    """A value out of a file's path, as the folder has it: '+' is no blank there, and both escapes are undone."""
    return F.url_decode(F.replace(F.url_decode(F.replace(F.regexp_extract(F.col(column), pattern, 1), F.lit("+"), F.lit("%2B"))), F.lit("+"), F.lit("%2B")))


def scan_foreign(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Clean Parquet files of other writers (S4, S5), in any folders: the clean columns and ``ingest_ds``.

    The columns are as the files have them (``timestamp`` or ``ts``, any
    numeric types); one that no file has is NULL.  A file without any category
    takes that of its path.  They have no landing day unless a folder names it.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(*paths)
    named = category_from_path(files)
    at = "timestamp" if "ts" not in named.columns and "timestamp" in named.columns else "ts"
    columns = [F.col(f"`{at if f.name == 'ts' else f.name}`") if (at if f.name == "ts" else f.name) in named.columns else F.lit(None)
               for f in CLEAN_EVENTS.fields]
    day = F.nullif(F.regexp_extract(F.col("_path"), r"/ingest_ds=([0-9-]+)/", 1), F.lit("")).cast("date")
    return named.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, CLEAN_EVENTS.fields)], day.alias("ingest_ds"), F.col("_path").alias("file"))


def category_from_path(df: DataFrame) -> DataFrame:
    """S5 for files read without partition discovery: when a file has no
    category value at all, take ``category=…`` from its path.

    The per-file test is an aggregate (one row per file) joined back on the
    file path, not a window over all rows of a file.  Adds ``_path``.
    """
    with_path = df.select("*", F.col("_metadata.file_path").alias("_path"))
    from_path = F.nullif(_from_path("_path", CATEGORY_IN_PATH), F.lit(""))
    if "category" not in df.columns:
        return with_path.withColumn("category", from_path)
    per_file = with_path.groupBy("_path").agg(F.count("category").alias("_n_cat"))
    return (with_path.join(per_file, "_path")
            .withColumn("category", F.when(F.col("_n_cat") == 0, from_path).otherwise(F.col("category")))
            .drop("_n_cat"))


def clean_event_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CLEAN_EVENTS.fields], "ingest_ds")

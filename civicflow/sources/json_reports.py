"""JSON document scan.

A file holds a JSON list of documents, or one document.  Each file is read
whole (the documents of a list must keep their order), parsed element-wise
into ``array<variant>`` — never one variant for the whole file, which has a
size limit — and exploded with its position.  A file that is neither a
list nor an object, or does not parse, yields no documents and shows up in
``quarantine`` instead of failing the batch.

A whole-text read is one task per file.  A list file larger than a split is
read in ranges instead, by many tasks, with the same result: an element that
is no JSON still makes the whole file unreadable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow import session
from civicflow.operators.parallel import spread
from civicflow.sources import json_ranges
from civicflow.sources.ranges import large_files, listed, listing, split_bytes


def read_files(spark: SparkSession, path: str | list[str], glob: str | None = None, up_to: int | None = None) -> DataFrame:
    """``(file_path, value)``: one row per file, whole text; only files of ``up_to`` bytes if given."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.text(path, wholetext=True)
    if up_to is not None:
        files = files.where(F.col("_metadata.file_size") <= up_to)
    return files.select(F.col("_metadata.file_path").alias("file_path"), "value")


def parse_files(files: DataFrame) -> DataFrame:
    """``(file_path, docs array<variant>)``; ``docs`` is NULL for an unreadable file."""
    text = F.regexp_replace("value", "^\ufeff", "")
    first = F.regexp_extract(text, r"^\s*(\S)", 1)
    obj = F.try_parse_json(text)
    docs = (F.when(first == "[", F.from_json(text, "array<variant>"))
            .when((first == "{") & obj.isNotNull(), F.array(obj)))
    return files.select("file_path", docs.alias("docs"))


def documents_of(files: DataFrame) -> DataFrame:
    """``(file_path, value)`` rows of whole files → one row per document."""
    parsed = parse_files(files)
    return (parsed.where(F.col("docs").isNotNull())
            .select("file_path", F.posexplode("docs").alias("pos", "doc")))


def _parts(spark: SparkSession, path: str, glob: str | None, split: int | None) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """Files to be read whole, the documents of large lists, and the large lists that are no JSON."""
    split = split_bytes(spark) if split is None else split
    files = listing(spark, path, glob)
    large = large_files(files, split)
    if not large:
        return read_files(spark, path, glob), None, []
    entry, others, bad = json_ranges.entries(spark, large)
    name = {f: listed(f) for f in {f for f, _ in entry} | set(others)}
    lists = sorted({f for f, _ in entry} - set(bad))
    whole = read_files(spark, path, glob, split)
    # compressed files, and large ones that hold no list
    rest = [r["path"] for r in files.filter((F.col("length") > split) & ~F.col("path").isin([name[f] for f in name if f not in others])).collect()]
    if rest:
        whole = whole.unionByName(read_files(spark, rest))
    if not lists:
        return whole, None, bad
    # cut once: the check of all elements and the documents read them
    cut = json_ranges.elements(spark, [name[f] for f in lists], {k: v for k, v in entry.items() if k[0] in set(lists)})
    folder = session.scratch(spark, "json-elements")
    cut.write.option("compression", "zstd").parquet(folder)
    docs = (spark.read.schema(cut.schema).parquet(folder)
            .select(F.col("file").alias("file_path"), F.col("pos").cast("int").alias("pos"), F.from_json(
                F.concat(F.lit("["), "text", F.lit("]")), "array<variant>").alias("one"))
            .select("file_path", "pos", F.when(F.size("one") == 1, F.col("one")[0]).alias("doc")))
    # one element that is no JSON makes the whole file unreadable
    wrong = [r["file_path"] for r in docs.where(F.col("doc").isNull()).select("file_path").distinct().collect()]
    return whole, docs.where(~F.col("file_path").isin(wrong)) if wrong else docs, sorted([*bad, *wrong])


def scan(spark: SparkSession, path: str, glob: str | None = None, split: int | None = None) -> DataFrame:
    """``(file_path, pos, doc variant)``, one row per document, file order kept.

    A list file of more than ``split`` bytes (a split of the session unless
    given) is read by many tasks, each a range of it (``json_ranges``).
    """
    whole, docs, _ = _parts(spark, path, glob, split)
    # a whole file is one task: spread its documents before normalisation
    out = spread(documents_of(whole))
    return out if docs is None else out.unionByName(docs)


def quarantine(spark: SparkSession, path: str, glob: str | None = None, split: int | None = None) -> DataFrame:
    """Files that yielded no documents because they could not be read as JSON."""
    whole, _, bad = _parts(spark, path, glob, split)
    out = parse_files(whole).where(F.col("docs").isNull()).select("file_path")
    if bad:
        out = out.unionByName(spark.createDataFrame([(f,) for f in bad], "file_path string"))
    return out


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line-delimited landing (``{"seq": n, "doc": {...}}`` per line).

    Files are split across tasks; ``pos`` is the landing sequence number, so
    "later document wins" still holds.  ``file_path`` is the day directory
    (not the part file), which orders days as the list layout does.  Lines
    that do not parse are left out (see ``quarantine_lines``).
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    v = F.try_parse_json(F.col("value"))
    day_dir = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    return (lines.select(day_dir.alias("file_path"), v.alias("v"))
            .where(F.col("v").isNotNull())
            .select("file_path", F.try_variant_get("v", "$.seq", "long").alias("pos"),
                    F.try_variant_get("v", "$.doc", "variant").alias("doc")))


def quarantine_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a line-delimited landing that are not JSON."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return (lines.where(F.try_parse_json(F.col("value")).isNull())
            .select(F.col("_metadata.file_path").alias("file_path"), "value"))

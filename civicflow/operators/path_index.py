"""An index of documents by (path, value), kept by the batches that change them.

A posting says that a document has a value at a path: ``(path, hash of the
value, part, key of the document)``.  Postings lie in a snapshot table with
buckets of (path, hash, part), so a search reads the buckets of its path and
value and no other.  ``part`` deals the documents of one value, which may be a
third of all, over ``PARTS`` buckets.

A batch adds the postings of its new documents before they are in the table
and drops those that only the old ones had when they no longer are: at every
moment, also after a process that died, the index has a posting for all that
the table holds.  Buckets without a posting that changes are shared with the
version before.

A path is written as a JSON pointer: keys and places behind ``/``.  Every node
of a document has a posting with its text, as a path lookup gives it:
containers with their JSON.  Elements of arrays have one more under ``*`` in
place of their number, for containment, which asks for no order.

Hashes only choose candidates: the documents themselves are tested, with the
same test as a full scan, so equal hashes of different values do no harm.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow import session
from civicflow.sinks.snapshots import Snapshot

PARTS = 16
POSTINGS = T.StructType([T.StructField("path", T.StringType(), False), T.StructField("value_hash", T.LongType(), False),
                         T.StructField("part", T.IntegerType(), False), T.StructField("key", T.StringType(), False)])
_KEY = [f.name for f in POSTINGS.fields]
# candidates of this many keys or fewer are fetched by their buckets, more by a join
FETCH_KEYS = 1000


def index_table(spark: SparkSession, path: str, **options) -> Snapshot:
    return Snapshot(spark, path, POSTINGS, buckets=["path", "value_hash", "part"], **options)


def pointer(path: str) -> str:
    """``$.a['b c'][0]`` as ``/a/b c/0``."""
    if not re.fullmatch(r"""\$(\.[A-Za-z_][A-Za-z0-9_]*|\['[^']*'\]|\["[^"]*"\]|\[[0-9]+\])*""", path):
        raise ValueError(f"not a path: {path}")
    steps = re.findall(r"""\.([A-Za-z_][A-Za-z0-9_]*)|\['([^']*)'\]|\["([^"]*)"\]|\[([0-9]+)\]""", path)
    return "".join("/" + _escaped(next(s for s in step if s)) if any(step) else "/" for step in steps)


def _escaped(key: str) -> str:
    return key.replace("~", "~0").replace("/", "~1")


def postings_of(docs: DataFrame, key: str, doc: str) -> DataFrame:
    """Distinct postings of a batch: one level of the documents after the other, until none holds another one."""
    spark = docs.sparkSession
    level = docs.select(F.col(key).cast("string").alias("key"), F.lit("").alias("path"), F.col(doc).alias("v"))
    found: DataFrame | None = None
    while True:
        folder = session.scratch(spark, "paths")
        level.write.parquet(folder)
        level = spark.read.schema(level.schema).parquet(folder)
        here = level.select("key", "path", F.try_variant_get("v", "$", "string").alias("text")).where("text is not null")
        found = here if found is None else found.unionByName(here)
        inner = level.where(F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)<."))
        if inner.limit(1).count() == 0:
            break
        step = F.replace(F.replace("k", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        nodes = spark.sql("SELECT {d}.key, path, x.pos, x.key AS k, x.value AS v FROM {d}, LATERAL variant_explode(v) x", d=inner)
        steps = F.when(F.col("k").isNotNull(), F.array(step)).otherwise(F.array(F.col("pos").cast("string"), F.lit("*")))
        level = nodes.select("key", "path", "v", F.explode(steps).alias("step")).select("key", F.concat("path", F.lit("/"), "step").alias("path"), "v")
    return found.select(F.col("path"), F.xxhash64("text").alias("value_hash"), F.pmod(F.xxhash64("key"), F.lit(PARTS)).cast("int").alias("part"), "key").distinct()


def add(index: Snapshot, new: DataFrame, key: str, doc: str, done: tuple[str, int] | None = None) -> int:
    """The postings of documents that are about to be in the table, beside those of their old versions."""
    return index.merge(postings_of(new, key, doc), _KEY,
                       lambda current, batch: current.join(batch, _KEY, "left_anti").unionByName(batch), done)


def drop(index: Snapshot, old: DataFrame, new: DataFrame, key: str, doc: str, done: tuple[str, int] | None = None) -> int:
    """The postings that only the old versions of documents had go, once the new ones are in the table."""
    gone = postings_of(old, key, doc).join(postings_of(new, key, doc), _KEY, "left_anti")
    return index.merge(gone, _KEY, lambda current, batch: current.join(batch, _KEY, "left_anti"), done)


def _holders(index: Snapshot, path: str, value: str) -> DataFrame:
    """Keys of the documents that may have ``value`` at ``path``; reads the buckets of the path and value only."""
    one = index.spark.range(PARTS).select(F.lit(path).alias("path"), F.xxhash64(F.lit(value)).alias("value_hash"), F.col("id").cast("int").alias("part"))
    folders = index.version().folders
    if folders:
        names = {r[0] for r in one.select(index._bucket(index._prefixes(folders))).distinct().collect()}
        folders = [f for f in folders if f.rsplit("=", 1)[1] in names]
    return (index._read(folders).where((F.col("path") == path) & (F.col("value_hash") == F.xxhash64(F.lit(value)))).select("key").distinct())


def _fetched(table: Snapshot, keys: DataFrame, key: str) -> DataFrame:
    """The rows of a table with these keys: by its buckets if they are few."""
    few = [r["key"] for r in keys.limit(FETCH_KEYS + 1).collect()]
    if len(few) <= FETCH_KEYS:
        return table.find(*few) if few else table.read().limit(0)
    return table.read().join(keys.withColumnRenamed("key", key), key, "left_semi")


def search(table: Snapshot, index: Snapshot, path: str, value: str, key: str = "external_id", doc: str = "original_doc") -> DataFrame:
    """Rows whose document has ``value`` at ``path``, as a full scan finds them."""
    keys = _holders(index, pointer(path), value)
    return _fetched(table, keys, key).where(F.try_variant_get(F.col(doc), path, "string") == F.lit(value))


# --------------------------------------------------------------------------
# containment

def contains(doc: Column, pattern) -> Column:
    """Whether a document holds a JSON value: all keys of objects, and each element of arrays somewhere in the array.

    Numbers are equal by value; an array holds a single string, number or
    boolean that is one of its elements, at the top only.
    """
    found = _holds(doc, pattern)
    if not isinstance(pattern, (dict, list)):
        found = found | _some(doc, pattern)
    return F.coalesce(found, F.lit(False))


def _elements(v: Column) -> Column:
    return F.when(F.schema_of_variant(v).startswith("ARRAY<"), F.try_variant_get(v, "$", "array<variant>"))


def _some(v: Column, pattern) -> Column:
    return F.coalesce(F.exists(_elements(v), lambda e: _holds(e, pattern)), F.lit(False))


def _holds(v: Column, pattern) -> Column:
    kind = F.schema_of_variant(v)
    if isinstance(pattern, dict):
        fields = [_holds(F.try_variant_get(v, "$[" + json.dumps(k, ensure_ascii=False) + "]", "variant"), p) for k, p in pattern.items()]
        return reduce(lambda a, b: a & b, fields, F.coalesce(kind.startswith("OBJECT<"), F.lit(False)))
    if isinstance(pattern, list):
        return reduce(lambda a, b: a & b, [_some(v, p) for p in pattern], F.coalesce(kind.startswith("ARRAY<"), F.lit(False)))
    if pattern is None:
        same = kind == "VOID"
    elif isinstance(pattern, bool):
        same = (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == pattern)
    elif isinstance(pattern, (int, float)):
        same = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & (F.try_variant_get(v, "$", "double") == float(pattern))
    else:
        same = (kind == "STRING") & (F.try_variant_get(v, "$", "string") == pattern)
    return F.coalesce(same, F.lit(False))


def _texts(pattern, path: str = "") -> list[tuple[str, str]]:
    """(path, text) of the strings and booleans of a pattern: what the index can be asked for."""
    if isinstance(pattern, dict):
        return [x for k, p in pattern.items() for x in _texts(p, f"{path}/{_escaped(k)}")]
    if isinstance(pattern, list):
        return [x for p in pattern for x in _texts(p, f"{path}/*")]
    # a number has several texts (1, 1.0)
    return [(path, str(pattern).lower() if isinstance(pattern, bool) else pattern)] if isinstance(pattern, (str, bool)) else []


def find_containing(table: Snapshot, index: Snapshot, pattern, key: str = "external_id", doc: str = "original_doc") -> DataFrame:
    """Rows whose document contains ``pattern``, as a full scan finds them; a pattern without text is looked for by a scan."""
    asked = _texts(pattern)
    if not asked or not isinstance(pattern, (dict, list)):
        return table.read().where(contains(F.col(doc), pattern))
    keys = reduce(lambda a, b: a.join(b, "key", "left_semi"), [_holders(index, path, text) for path, text in asked])
    return _fetched(table, keys, key).where(contains(F.col(doc), pattern))

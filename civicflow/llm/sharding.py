"""Proportional stratified interleaving: shards that all have the table's mixture of sources.

Rows are shuffled by a seeded hash and ranked within their source; sorted by
fractional rank (rank - 1/2) / size of the source, every stretch of the order
holds each source in proportion, so cutting the order into equal parts gives
shards with the mixture, and counts at most one apart.

Ranks come without a global sort and without one task for a source: rows fall
into about sqrt(rows) hash buckets a source, bucket sizes are summed up in
order, and only the rows of one bucket are sorted together.  The order of
fractional ranks is cut the same way.

Cases: a null source is a source of its own; a null text has size 1; a null
id is an id; rows that are equal in id and text are interchangeable and get
different slots, and however many they are no task gets them all; an empty table gives no rows; input columns with the names
of result columns are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicflow.llm.stages import written
from civicflow.llm.textmap import others, quoted

# a bucket of so many times the usual rows is dealt anew
HOT = 8


def bucketed(rows: DataFrame, total: int, buckets: int, seed: int) -> DataFrame:
    """``rows`` with the hash they are shuffled by and its bucket ``b`` of the source.

    Rows that are equal in id and text have one hash.  Where they overfill a
    bucket its rows are shuffled by the row's number as well, which deals
    them over the whole source.
    """
    def placed(df: DataFrame, h) -> DataFrame:
        # unsigned order of the hash: its upper 31 bits, then all of it
        return (df.withColumn("h", h).withColumn("high", F.shiftrightunsigned("h", 33))
                .withColumn("b", F.floor(F.col("high") * F.lit(buckets) / F.lit(1 << 31)).cast("int")))

    plain = placed(rows, F.xxhash64(F.lit(seed), "id", "crc", "size"))
    full = HOT * max(total // buckets, 1)
    # each holds more than HOT / buckets of all rows: at most buckets / HOT of them, about sqrt(rows) / HOT
    hot = plain.groupBy("s", "b").agg(F.count("*").alias("n")).filter(F.col("n") > full).select("s", "b", F.lit(True).alias("hot"))
    joined = plain.join(F.broadcast(hot), ["s", "b"], "left")
    return placed(joined.drop("b", "high"), F.when(F.col("hot"), F.xxhash64(F.lit(seed), "id", "crc", "size", "row")).otherwise(F.col("h")))


def assign(docs: DataFrame, shards: int = 16, stratum: str = "source", doc_id: str = "doc_id", text: str = "text",
           seed: int = 42, keep: list[str] | None = None) -> DataFrame:
    """Adds size, text_crc32, shard and slot (0, 1, ... within the shard) to the kept columns."""
    carried = others(list(docs.columns if keep is None else keep), ["size", "text_crc32", "shard", "slot"])
    value = quoted(text).cast("string")
    name = quoted(doc_id).cast("string")
    rows = docs.select(
        *[quoted(c).alias(f"c{i}") for i, c in enumerate(carried)],
        (F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("crc"),
        F.coalesce(F.concat(F.lit("s:"), quoted(stratum).cast("string")), F.lit("null")).alias("s"),
        F.coalesce(name, F.lit("")).alias("id"), F.monotonically_increasing_id().alias("row"))
    # written once: the texts are read once, and the numbers of rows stay as they are
    rows = written(rows, "shard-rows")
    total = rows.count()
    buckets = 1 << max(0, round(math.log2(max(total, 1)) / 2))
    rows = bucketed(rows, total, buckets, seed)
    sizes = rows.groupBy("s", "b").agg(F.count("*").alias("n"))
    # a source has at most `buckets` rows here
    ordered = Window.partitionBy("s").orderBy("b")
    starts = sizes.select("s", "b", (F.sum("n").over(ordered) - F.col("n")).alias("before"),
                          F.sum("n").over(Window.partitionBy("s")).alias("in_source"))
    exact = ["high", "h", "id", "size", "crc"]
    ranked = (rows.withColumn("r", F.row_number().over(Window.partitionBy("s", "b").orderBy(*exact)))
              .join(starts, ["s", "b"]))
    ranked = ranked.withColumn("f", (F.col("before") + F.col("r") - F.lit(0.5)) / F.col("in_source"))
    ranked = ranked.withColumn("g", F.floor(F.col("f") * buckets).cast("int"))
    cuts = ranked.groupBy("g").agg(F.count("*").alias("n"))
    # about sqrt(rows) rows
    cuts = cuts.select("g", (F.sum("n").over(Window.orderBy("g")) - F.col("n")).alias("ahead"))
    placed = (ranked.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy("f", "s", *exact)))
              .join(cuts, "g").withColumn("p", F.col("ahead") + F.col("p") - 1))
    shard = F.expr(f"int(p * {shards}L div {max(total, 1)}L)")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("p") - first)
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "size", F.col("crc").alias("text_crc32"), "shard",
                    F.col("slot").cast("long").alias("slot")))


def write_shards(assigned: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder for each shard, rows in slot order within each file; a file holds a run of slots."""
    (assigned.withColumn("part", F.floor(F.col("slot") / rows_per_file)).repartition("shard", "part")
     .sortWithinPartitions("shard", "slot").drop("part").write.partitionBy("shard")
     .option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path))

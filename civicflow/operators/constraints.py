"""Table constraint checks (P14): NOT NULL and UNIQUE as aggregates.

A check job reports the violations of a table: one row per (table, rule).
Both checks are single aggregations with partial aggregation, so a hot key
costs nothing extra.

Merges into snapshot tables enforce them: ``split`` divides a batch into the
rows that a database would have taken and those it would have refused, each
with the first rule it breaks.  Of several rows with one key the last in order
of their text stays; which one that is does not depend on partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column: how many rows hold NULL there."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c} not null', `{c}`" for c in columns)
    return counts.select(F.lit(table).alias("table_name"),
                         F.expr(f"stack({len(columns)}, {stack}) AS (rule, violations)"))


def unique(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Number of key values held by more than one row (NULL keys excluded)."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    dupes = (df.where(present).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.count_if(F.col("n") > 1).alias("violations")))
    return dupes.select(F.lit(table).alias("table_name"),
                        F.lit(f"({', '.join(key)}) unique").alias("rule"), "violations")


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks).select(
        "table_name", "rule", F.col("violations").cast("long").alias("violations"))


def table_checks(df: DataFrame, table: str, not_null: list[str] = (), unique_key: list[str] | None = None) -> DataFrame:
    """All checks of one table in one pass over it.

    With a unique key, rows are grouped by the key once (partial aggregation
    before the shuffle) while NULLs of the NOT NULL columns are counted per
    group; a second, tiny aggregation adds the groups up.  Rows: one per
    NOT NULL column, then one for the key.
    """
    not_null = list(not_null)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(not_null)]
    rules = [(f"{c} not null", f"_null{i}") for i, c in enumerate(not_null)]
    if unique_key:
        present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in unique_key])
        per_key = df.groupBy(*unique_key).agg(F.count(F.lit(1)).alias("_n"), *nulls)
        totals = per_key.agg(*[F.coalesce(F.sum(f"_null{i}"), F.lit(0)).alias(f"_null{i}")
                               for i in range(len(not_null))],
                             F.count_if(present & (F.col("_n") > 1)).alias("_dupes"))
        rules.append((f"({', '.join(unique_key)}) unique", "_dupes"))
    else:
        totals = df.agg(*nulls)
    stack = ", ".join(f"'{rule}', CAST(`{col}` AS BIGINT)" for rule, col in rules)
    return totals.select(F.lit(table).alias("table_name"),
                         F.expr(f"stack({len(rules)}, {stack}) AS (rule, violations)"))


def rule_of(key: list[str]) -> str:
    return f"({', '.join(key)}) unique"


def _present(key: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])


def violated(batch: DataFrame, required: list[str], keys: list[list[str]], taken: dict[tuple, DataFrame]) -> bool:
    """Whether a row lacks a required value, shares a key with another one or has a value that is taken."""
    if required and batch.filter(~_present(required)).limit(1).count():
        return True
    if any(batch.filter(_present(u)).groupBy(*u).count().filter("count > 1").limit(1).count() for u in keys):
        return True
    return any(batch.join(values, list(u), "left_semi").limit(1).count() for u, values in taken.items())


def numbered(batch: DataFrame) -> DataFrame:
    """The batch with ``_row``, a number, and ``_text``, the row as JSON."""
    return batch.withColumn("_text", F.to_json(F.struct(*[F.col(c) for c in batch.columns]))).withColumn("_row", F.monotonically_increasing_id())


def split(rows: DataFrame, required: list[str], keys: list[list[str]], taken: dict[tuple, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Written ``numbered`` rows → those that hold the rules, and (rule, row) of the others."""
    first = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"{c} not null")) for c in required], F.lit(None).cast("string"))
    refused = [rows.select(first.alias("rule"), F.col("_text").alias("row")).filter("rule is not null")]
    good = rows.filter(_present(required)) if required else rows
    for u in keys:
        # partial aggregation first: a key that many rows share is one row of each task
        stay = good.filter(_present(u)).groupBy(*u).agg(F.max(F.struct("_text", "_row")).alias("last")).select(F.col("last._row").alias("_row"))
        keyed = good.filter(_present(u))
        refused.append(keyed.join(stay, "_row", "left_anti").select(F.lit(rule_of(u)).alias("rule"), F.col("_text").alias("row")))
        good = good.filter(~_present(u)).unionByName(keyed.join(stay, "_row", "left_semi"))
        if tuple(u) in taken:
            refused.append(good.join(taken[tuple(u)], u, "left_semi").select(F.lit(rule_of(u)).alias("rule"), F.col("_text").alias("row")))
            good = good.join(taken[tuple(u)], u, "left_anti")
    return good, reduce(DataFrame.unionByName, refused)

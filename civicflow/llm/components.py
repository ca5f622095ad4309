"""Connected components of an edge list by alternating large-star and small-star steps.

Each step is a minimum per node (a partial aggregation, so a hub costs no
more than others) and a join on the node that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.stages import written


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; ``edges`` has columns a and b; a component is its smallest node."""
    current = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                                F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        current = written(small.select("e.a", "e.b").filter("a <> b").distinct(), "small-star")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return current.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

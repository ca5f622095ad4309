"""The numbered queries over the given tables, and the SQL of those that DuckDB can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm import bpe as op9
from civicflow.llm import decontaminate as op10
from civicflow.llm import jaccard as op8
from civicflow.llm import language as op6
from civicflow.llm import line_runs as op12
from civicflow.llm import quality_rules as op1
from civicflow.llm import repeats as op2
from civicflow.llm import search as op11
from civicflow.llm import secrets as op7
from civicflow.llm import sharding as op5
from civicflow.llm import surrogates as op4
from civicflow.llm import weak_quality as op3
from civicflow.llm import whitening as op13
from civicflow.llm.oracles import ORACLES

# the key of the registered queries; a deployment passes its own secret
SURROGATE_KEY = "surrogates of the registered queries"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return op1.quality_rules(docs, _table(spark, sf_dir, "labels"), keep=["doc_id"])


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return op2.remove_repeats(docs, keep=["doc_id"]).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return op3.classify(docs, keep=["doc_id"])


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.replace(_table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op5_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return op5.assign(docs, 16, keep=["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = op6.train(docs.filter(~op6.held_out("doc_id")))
    return (op6.predict(docs, model, keep=["doc_id"])
            .select("doc_id", op6.held_out("doc_id").alias("held_out"), "lang_pred", "score"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = op7.scan(docs, keep=["doc_id"])

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = op9.encode(docs, path, keep=["doc_id"], decoded=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = op10.decontaminate(docs, _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return op11.search(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return op12.drop_lines(docs, keep=["doc_id"]).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the sum of squares is null where a long cannot hold it
    return op13.whiten(_table(spark, sf_dir, "embeddings"), keep=["vec_id"]).withColumn(
        "deviation", F.expr("try_cast(deviation as bigint)"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_stratified_shards": op5_stratified_shards,
    "op6_language_id": op6_language_id,
    "op7_secret_scan": op7_secret_scan,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_bpe": op9_bpe,
    "op10_decontaminate": op10_decontaminate,
    "op11_ranked_search": op11_ranked_search,
    "op12_line_dedup": op12_line_dedup,
    "op13_embedding_whitening": op13_embedding_whitening,
}

__all__ = ["QUERIES", "ORACLES"]

"""The queries of this subpackage by name, each a thin use of its operator on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat_formatting,
    licenses,
    mixing,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    target_sampling,
    token_files,
    topk,
    toxicity,
    turn_repair,
)
from tidemark.llm.common import table
from tidemark.llm.oracle import ORACLE_SQL  # noqa: F401  given to the driver with the queries
from tidemark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: Tokens in a packed sequence, and the id that ends a document.
SEQUENCE = 1024
END_ID = 2


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file, at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.search(rows, lambda vec_id: vec_id % 20 == 0, k=20, scale=64)


def op2_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_quadratic_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality_classifier.score(docs, table(spark, folder, "labels"), ["doc_id"], parts=3, part=1)
    return scored.select("doc_id", quality_classifier.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


def op4_recurrent_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, table(spark, folder, "labels"), ["doc_id"], parts=4, part=2, threshold=0.3)
    return scored.select("doc_id", quality_classifier.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates.near_duplicates(docs, size=4, percent=80)


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = packing.pieces(docs, tokenizer_path("byte_bpe_50k.json"), END_ID, SEQUENCE)
    return packing.pack(cut, SEQUENCE)


def op7_balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.assign(docs, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_license_digests(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.known_digests(spark), licenses.anchors(licenses.known_texts()))
    return found.select("doc_id", "license", F.array_join("part_licenses", " ").alias("part_licenses"), "n_parts", "n_rows")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.judge(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_indexed_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    store = scratch_path(spark, "tokens")
    manifest = token_files.write(docs, store, tokenizer_path("word_bpe_49k.json"), END_ID)
    return token_files.read(spark, manifest, store)


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    roles = F.explode(F.array(F.lit("user"), F.lit("assistant"))).alias("role")
    added = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), roles, said.alias("text"))
    added = added.select("conv_id", F.when(F.col("role") == "user", 0).otherwise(1).cast("long").alias("turn"), "role", "text")
    return chat_formatting.read_conversations(chat_formatting.written(rows.unionByName(added)))


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = turn_repair.damaged(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    return turn_repair.repair(rows, F.col("dropped"))


def op13_target_sampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return target_sampling.resample(docs, table(spark, folder, "benchmark").select("text"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_exact_top_k, op2_entropy_mix, op3_quadratic_quality, op4_recurrent_toxicity, op5_near_duplicates, op6_best_fit_packing,
        op7_balanced_shards, op8_license_digests, op9_quality_rules, op10_indexed_tokens, op11_chat_format, op12_turn_repair, op13_target_sampling,
    )
}

"""Queries of the text operators over the given tables, and the SQL that some must agree with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mishap.llm import (
    byte_bpe,
    chat,
    divergence,
    embeddings,
    fingerprints,
    merkle,
    ngrams,
    packing,
    pii,
    sharding,
    sql,
    substrings,
    token_counts,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.digest(substrings.remove_repeats(docs, 50))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), model)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.digests(byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(packing.tokenise(table(spark, sf_dir, "documents"), tokenizer))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 8)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.report(pii.detect(docs, pii.fit(docs)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    _, scored = toxicity.fit_and_score(docs, table(spark, sf_dir, "labels"), ["doc_id"])
    return toxicity.verdicts(scored)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.jaccard_components(table(spark, sf_dir, "documents"), 3, 90)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), 30, 50)


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    rows = given.unionByName(spark.createDataFrame(tricky, "conv_id long, turn long, role string, text string"))
    transcripts = chat.render(chat.messages(chat.log_of_rows(rows)))
    return chat.digests(chat.read_back(transcripts))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_fingerprints": op4_fingerprints,
    "op5_packing": op5_packing,
    "op6_sharding": op6_sharding,
    "op7_pii": op7_pii,
    "op8_toxicity": op8_toxicity,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_source_divergence": op12_source_divergence,
    "op13_chat_formatting": op13_chat_formatting,
}

ORACLES = {
    "op1_substring_dedup": sql.SUBSTRING_SQL,
    "op9_ngram_jaccard_join": sql.JACCARD_SQL,
    "op10_embedding_near_dedup": sql.VECTORS_SQL,
    "op11_merkle_manifest": sql.MERKLE_SQL,
    "op12_source_divergence": sql.DIVERGENCE_SQL,
    "op13_chat_formatting": sql.CHAT_SQL,
}

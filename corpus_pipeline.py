"""A corpus from raw documents to packed token sequences, stage by stage.

Every stage reads what the one before has written and works on all of it. The first four return the
columns of ``documents``, the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mishap.llm import ngrams, packing, pii, substrings, toxicity
from mishap.llm.common import quoted, staged

KEY = "_near_copy_key"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the labels not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    _, scored = toxicity.fit_and_score(docs, labels, docs.columns)
    return scored.where("_score < 0.5").select(*map(quoted, docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by five-word shingles at 0.8, one stays: that with the least id.

    Rows are told apart by id and text, so rows of one id with different texts are judged each on its
    own, and rows without id take part, after those that have one. Rows that repeat both id and text
    are one document. Documents without words are linked with nothing and stay.
    """
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text"))
    keyed = docs.withColumn(KEY, key)
    linked = ngrams.jaccard_components(keyed, n=5, percent=80, row_id=KEY)
    first = linked.where(F.col(KEY) == F.col("component_id")).select(KEY).distinct()
    return keyed.join(first, KEY, "left_semi").dropDuplicates([KEY]).select(*map(quoted, docs.columns))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand in an earlier document go; untouched texts keep their spacing."""
    found = substrings.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("text"))
    return _with_text(found, text, docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind in brackets."""
    found = pii.detect(docs, pii.fit(docs))
    return _with_text(found, pii.redacted(F.col("text"), F.col("pii")), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, with a checksum of their ids."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(packing.tokenise(docs, tokenizer))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _with_text(docs: DataFrame, text: F.Column, columns: list[str]) -> DataFrame:
    changed = docs.withColumn("text", text)
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(columns)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

# Learned models, components and tokenizers are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

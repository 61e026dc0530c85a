"""The corpus pipeline: documents to token ids in five stages, each working on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictforge.llm import bpe, mixing, simhash, substring_dedup, toxicity
from dictforge.session import stage

TOKENIZER = "byte_bpe_50k.tiktoken"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, fitted on the labels that are not held out, calls toxic."""
    model = toxicity.fit_tables(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs, model)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of documents whose fingerprints link at two or fewer bits."""
    return simhash.one_of_each(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated lines and passages out of all but the first document; no document goes."""
    cleaned = substring_dedup.remove_repeats(docs).drop("_removed")
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come near their targets; a copy is a row."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, little-endian unsigned 32-bit."""
    encoded = bpe.encode(
        docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, keys=("doc_id", "lang", "source")
    )
    return encoded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", one_per_group),
    ("substring_dedup", remove_repeats),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

# The classifier, the fingerprints and the encoder have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what each returns is written and read again, as its rows are used often."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

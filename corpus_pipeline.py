"""A training corpus from ``documents``: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage
returns as Parquet and hands the next one the table read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wxengine.llm import bpe, decontaminate, language_id, ngram_join, secret_scan
from wxengine.llm.queries import TOKENIZER, remainder
from wxengine.session import shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, or in no language that the model is sure of."""
    return language_id.reject_unidentified(docs, remainder(4) != 2)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates.

    Near duplicates share four fifths of their five-word shingles; ``op3_ngram_join`` has a
    narrower rule of its own.
    """
    return ngram_join.keep_one(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents of which benchmark passages make up a twentieth or more."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every document stays."""
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with a digest of what they decode to."""
    codec = bpe.read_codec(public_tokenizers.path(TOKENIZER))
    found = bpe.encode_decode(docs, codec, keep=("lang", "source"))
    return found.select(
        "doc_id",
        "lang",
        "source",
        bpe.unpacked(F.col("ids")).alias("ids"),
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("bpe", encode),
]

# SQL can express neither the language model nor BPE; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows that the last one returns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

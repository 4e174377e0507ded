"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideglass.llm import bpe
from tideglass.llm.credentials import mask_secrets
from tideglass.llm.langid import keep_identified
from tideglass.llm.mixing import take_mix
from tideglass.llm.neardup import drop_near_duplicates
from tideglass.llm.shipping import ship
from tideglass.sources.workspace import stage

RANKS = "byte_bpe_multi_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language (operator 8); the others go."""
    ship(spark)
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (operator 5)."""
    ship(spark)
    return drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked (operator 7); ``n_chars`` is that of the new text."""
    ship(spark)
    return mask_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (operator 9)."""
    ship(spark)
    return take_mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every row, and the hash of what they decode to (operator 10)."""
    ship(spark)
    ranks = public_tokenizers.path(RANKS)
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id", "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("secrets", secrets),
    ("mixing", mixing), ("byte_bpe", byte_bpe),
]

#: The trained models and the hashes of near copies have no SQL; tests hold each stage against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

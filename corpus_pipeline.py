"""A corpus from raw documents to packed training sequences.

Each stage is one of the operators in scholaris.llm, works on all that its predecessor
kept and returns what it keeps with the columns of `documents`; the last returns the
packed pieces. Every result is written to the shared folder and read again.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaris.llm import packing, quality, simhash, substring
from scholaris.sources.workspace import new_path

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the compression bands; the others go."""
    return quality.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash, the one with the least id."""
    return simhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words in windows of 35 words that occur twice or more.

    A document without such words keeps its text as it is. One that loses all its words
    stays as an empty document.
    """
    found = substring.deduplicated(docs)
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in pieces, each with its sequence and place there."""
    return packing.packed_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packed),
]

# Compression, fingerprints and tokenizers are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the table `documents` in a directory."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

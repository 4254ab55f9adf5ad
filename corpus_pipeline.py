"""From raw documents to token ids: classify, clean, keep one of each near-duplicate group, mix sources, encode.

Each stage takes the rows its predecessor kept, written as Parquet and read again, and returns the columns of
``documents``; the last returns token ids. A stage treats nulls, empty texts, repeated rows and empty tables as its
operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.llm import byte_bpe, jaccard_join, line_rules, mixing, quality_gbdt
from estrato.llm.queries import training_labels
from estrato.session import ship_package, stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts; it learns from the training labels of the given documents."""
    ship_package(spark)
    forest = quality_gbdt.learn(docs, training_labels(spark, sf_dir))
    return docs.where(quality_gbdt.scorer(forest)("text") >= quality_gbdt.THRESHOLD)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the line rules, without the lines that failed."""
    ship_package(spark)
    return line_rules.cleaned_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component."""
    ship_package(spark)
    return jaccard_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the byte ends they decode by, with a digest of the decoded bytes."""
    ship_package(spark)
    encoded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), read_back=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        "ends",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", token_ids),
]

# A trained classifier, seeded subset sums and merges by rank are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

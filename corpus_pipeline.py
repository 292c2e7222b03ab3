"""A training corpus from ``documents``: classified, deduplicated three ways and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the docs of the next.  All but the last return
the columns that they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenderlake.llm import exact_dedup, near_dedup, packing, quality, queries, shared, substrings


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, doesn't reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    return exact_dedup.keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, a similarity of 0.8 or more."""
    return near_dedup.keep_one_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that an earlier document has."""
    return substrings.without_repeats(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, queries.tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("substring dedup", repeated_passages),
    ("packing", packed_sequences),
]

#: SQL can't express the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

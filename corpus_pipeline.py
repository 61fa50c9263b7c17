"""A corpus from documents: toxic documents go, one of each group of near duplicates stays, documents with benchmark
items go, personal data is masked, and what is left is packed into sequences.

Every stage takes (spark, docs, sf_dir), works on all rows of its ``docs`` and returns a frame; all but the last return
the columns of ``docs``. The stages' operators say what they do with nulls, empty and long texts, and repeated rows;
an empty table stays empty. ``run`` writes each result into the shared folder and hands the written table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillcast.llm import decontaminate, near_dup, packing, pii, toxicity
from tillcast.session import stage

#: Words of a shingle and percent of similarity of near duplicates.
SHINGLE, SIMILARITY = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a model of the labelled ones finds toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.keep_first(docs, SHINGLE, SIMILARITY)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the names of its kinds."""
    return pii.masked(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: The stages fit a model, link sets, edit texts and tokenize, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs

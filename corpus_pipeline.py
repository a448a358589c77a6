"""A cleaning pipeline over ``documents``: each stage reads what its predecessor kept."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm import contamination, pieces, simhash, suffixes, toxicity
from leadmill.llm.common import prepare, table
from leadmill.session import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the cut go; the model learns from the labels of the corpus."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_per_group(docs)


def drop_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that already stand earlier leave the texts."""
    return suffixes.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and whether they decode to it."""
    known = pieces.vocabulary(prepare(spark))
    return pieces.encode_with_check(docs, known)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_bytes),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", tokenize),
]

# Learned weights, hashes of bytes and a vocabulary file are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each result is written and read again as the next stage's input."""
    prepare(spark)
    base = scratch_dir(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = os.path.join(base, f"{i}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

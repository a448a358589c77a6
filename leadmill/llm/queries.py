"""Queries of the operators over their whole tables, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm import oracles, quality, toxicity
from leadmill.llm.chat import neighbours, preference_turns
from leadmill.llm.common import prepare, table
from leadmill.llm.contamination import contaminated
from leadmill.llm.hnsw import similar_vectors
from leadmill.llm.licenses import scan
from leadmill.llm.mixing import language_scores
from leadmill.llm.pieces import digests, vocabulary
from leadmill.llm.placement import place
from leadmill.llm.search import ranked
from leadmill.llm.simhash import simhash_groups
from leadmill.llm.suffixes import repeated_bytes
from leadmill.llm.trie import prefix_trie

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {
    "op1_hnsw": oracles.OP1,
    "op5_suffix_dedup": oracles.OP5,
    "op6_preference": oracles.OP6,
    "op9_placement": oracles.OP9,
    "op12_ranked_search": oracles.OP12,
    "op13_prefix_trie": oracles.OP13,
}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = vocabulary(prepare(spark))
    return digests(table(spark, sf_dir, "documents"), known)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels.where(toxicity.remainder(3) != 1))
    held_out = F.coalesce(toxicity.remainder(3) == 1, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= toxicity.CUT).cast("int").alias("predicted")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", predicted)


@query
def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest turns' texts are long, so the checksum of a rendered turn stands for it."""
    parts = preference_turns(*neighbours(table(spark, sf_dir, "conversations")))
    return parts.select("pair_id", "part", "turn", "role", "loss", F.length("rendered").cast("long").alias("n_chars"), F.md5("rendered").alias("rendered_md5"))


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


@query
def op9_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, labels.where(toxicity.remainder(4) != 2))
    held_out = F.coalesce(toxicity.remainder(4) == 2, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= quality.CUT).cast("int").alias("predicted")
    return quality.score(docs, model).select("doc_id", held_out, "score", predicted)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))

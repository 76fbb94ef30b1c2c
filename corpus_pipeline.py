"""From raw documents to token shards: five stages, each one operator over all that the last kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from spanwatch.llm import entropy_mix, feistel_shards, kneser_ney, simhash_gray, string_tiling
from spanwatch.llm.common import settle, table
from spanwatch.llm.queries import VOCABULARY
from spanwatch.sources.stages import stage_folder


def keep_good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's limit."""
    return kneser_ney.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return simhash_gray.representatives(docs)


def keep_clear_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return string_tiling.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return entropy_mix.mix_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, as written to shards."""
    path = f"{stage_folder(spark)}/spanwatch/shards-{uuid.uuid4().hex}"
    return feistel_shards.write_shards(docs, path, VOCABULARY)


STAGES = [
    ("quality classifier", keep_good_text),
    ("near-duplicates", keep_one_of_each),
    ("benchmark decontamination", keep_clear_of_benchmark),
    ("source mix", mix_sources),
    ("token shards", write_tokens),
]

# Perplexity, SimHash and tokens are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = settle(docs, f"pipeline-{number}")
    return docs

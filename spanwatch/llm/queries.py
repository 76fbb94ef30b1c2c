"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.llm import boosted_rules, conversation_repair, entropy_mix, feistel_shards, html_wrappers, kneser_ney, piece_bpe, preference_format, simhash_gray, string_tiling, token_alignment, url_rules, warc_revisits
from spanwatch.llm.common import table
from spanwatch.sources.stages import stage_folder

# Rank file of a public byte-level vocabulary for many languages.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# A byte-level vocabulary with merges, and a piece model.
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

PATH_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
PATTERN_RULES = [
    ("||ads.", "block"),
    ("||ads-track.", "block"),
    ("||casino-win.", "block"),
    ("||free-bets.", "block"),
    ("/ads/", "block"),
    ("/banner/", "block"),
    ("/wp-login", "block"),
    ("/cart^", "block"),
    ("?page=*&ref=", "block"),
    (".exe|", "block"),
    (".zip|", "block"),
]


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_revisits.captures_of_pages(table(spark, sf_dir, "pages"))
    found = warc_revisits.resolve_revisits(records)
    merged = lambda name: F.col("merged")[name]
    return found.select(
        "page_id",
        "record_id",
        "canonical",
        "response_id",
        "outcome",
        merged("etag").alias("etag"),
        merged("cache-control").alias("cache_control"),
        merged("content-type").alias("content_type"),
        merged("date").alias("date"),
    )


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.path_rules(spark, PATH_RULES).unionByName(url_rules.pattern_rules(spark, PATTERN_RULES))
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select(
        "page_id", "host", "path", F.when(F.col("tier") == 1, F.col("rule")).alias("rule"), "verdict"
    )


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{stage_folder(spark)}/spanwatch/shards-{uuid.uuid4().hex}"
    shards = feistel_shards.write_shards(table(spark, sf_dir, "documents"), path, VOCABULARY)
    return shards.select("shard", "slot", "n_tokens", "doc_ids", F.xxhash64("tokens").alias("token_hash"))


def op5_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_gray.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = entropy_mix.mix_plan(table(spark, sf_dir, "documents"), weights=(3, 1, 2), budget=1.5, cap=2.0)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op7_boosted_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = boosted_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *boosted_rules.COUNTS, "base_failed", "kept")


def op8_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_wrappers.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference_format.last_answer_pairs(table(spark, sf_dir, "conversations"))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return preference_format.format_pairs(pairs).select(
        "conv_id",
        "n_prompt_turns",
        "prompt",
        "chosen",
        "rejected",
        spans(F.col("chosen_mask")).alias("chosen_mask"),
        spans(F.col("rejected_mask")).alias("rejected_mask"),
    )


def op10_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(table(spark, sf_dir, "documents"), PIECES)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.alignments(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)
    hashed = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", hashed).drop("groups")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.summary(conversation_repair.repair(damaged))


QUERIES = {
    f.__name__: f
    for f in (
        op1_kneser_ney,
        op2_warc_revisits,
        op3_url_rules,
        op4_feistel_shards,
        op5_simhash_gray,
        op6_entropy_mix,
        op7_boosted_rules,
        op8_html_wrappers,
        op9_preference_format,
        op10_string_tiling,
        op11_piece_bpe,
        op12_token_alignment,
        op13_conversation_repair,
    )
}

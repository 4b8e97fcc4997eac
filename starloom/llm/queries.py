"""The queries of this folder's operators, ``{name: (spark, sf_dir) -> rows}``,
and the SQL that states their results where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import bitplane_store, conversations, cotraining, decontaminate, mixing, rules, sentencepiece_stream, simhash, suffix_array, suffix_trees, token_counts, warc, whitening
from starloom.llm.common import read_table
from starloom.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

TOKEN_LIMIT = 2048


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.remove_repeats(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(read_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))
    return counts.withColumn("over_limit", counts.n_tokens > TOKEN_LIMIT)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane_store.read_ids(bitplane_store.write_ids(read_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(read_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.remove_repeats(read_table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_stream.round_trip(read_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op8_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_items", "item_ids", "best_score", "contaminated")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(warc.mark_revisits(read_table(spark, sf_dir, "pages")))
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audits(conversations.damaged(conversations.rows_of(read_table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_token_ids": op4_token_ids,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_simhash_ball": op8_simhash_ball,
    "op9_decontamination": op9_decontamination,
    "op10_warc": op10_warc,
    "op11_mixing": op11_mixing,
    "op12_whitening": op12_whitening,
    "op13_conversation_repair": op13_conversation_repair,
}

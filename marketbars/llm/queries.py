"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.llm import (
    conversation_trie,
    decontaminate,
    hard_negatives,
    jaccard_join,
    language_id,
    line_dedup,
    lm_scoring,
    nearest_neighbours,
    packing,
    quality_rules,
    sequence_files,
    suffix_dedup,
    url_filters,
)
from marketbars.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]

# Host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"), words=3, percent=90)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), also=220)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_of_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_units(table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda x: F.concat_ws(":", x["first"], x["length"]))
    return found.withColumn("removed", F.array_join(spans, " "))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), added=True)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), rules)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(documents, benchmark)


def op10_sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return sequence_files.binary_output(documents, tokenizer_path(), added=True)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_nodes(table(spark, sf_dir, "conversations"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours.nearest_of_hundredths(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.negatives_of_fiftieths(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_language_id": op4_language_id,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_url_filters": op7_url_filters,
    "op8_quality_rules": op8_quality_rules,
    "op9_decontaminate": op9_decontaminate,
    "op10_sequence_files": op10_sequence_files,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_hard_negatives": op13_hard_negatives,
}

"""From raw documents to packed sequences: five operators, one after another.

Each stage's result is written to the shared folder and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.llm import decontaminate, jaccard_join, language_id, packing, suffix_dedup
from marketbars.llm.queries import tokenizer_path, vocabulary_path
from marketbars.llm.shared import free_name, importable, saved, table, with_text_id

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Bytes of the strings that the third stage removes: a passage of 50 words has
# more in all four languages of the corpus, wherever it begins in a line.
REPEATED_BYTES = 220


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without letters, or of no clear language, go.

    Learned from all documents with a text and a language. Where there is none,
    nothing can be told and all documents stay.
    """
    importable(spark)
    model = language_id.learn(docs, vocabulary_path())
    if not model:
        return docs
    names = free_name(docs, "lang_pred"), free_name(docs, "score")
    known = language_id.identify(docs, model, vocabulary_path(), names)
    clear = (F.col(names[0]) != language_id.UNKNOWN) & (F.col(names[1]) >= 0.5)
    return known.where(clear).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles, similarity 0.8 or more.

    The one with the smallest `doc_id` stays. Documents without words, and those
    without a `doc_id`, are in no group and stay. Rows that repeat a `doc_id`
    stay if one of them does, those that repeat the text as well once.
    """
    importable(spark)
    found = jaccard_join.link_documents(docs, words=5, percent=80)
    gone = found.groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("stays")
    )
    gone = gone.where(~F.col("stays")).select("doc_id")
    kept = docs.join(gone, "doc_id", "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings of `REPEATED_BYTES`.

    `n_chars`, where there is one, follows the text. A document of which nothing
    is left goes.
    """
    importable(spark)
    found = suffix_dedup.remove_repeats(docs, REPEATED_BYTES, keep_text=True)
    changed = found.where(F.col("n_removed") > 0).groupBy("id").agg(F.first("kept").alias("kept"))
    key, kept = free_name(docs, "text_id"), free_name(docs, "kept")
    changed = changed.select(F.col("id").alias(key), F.col("kept").alias(kept))
    joined = with_text_id(docs, key).join(changed, key, "left")
    text = F.coalesce(kept, "text")
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(text).cast("long")
    left = joined.where(F.col(kept).isNull() | (F.col(kept) != ""))
    return left.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage similar to a benchmark item."""
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    key = free_name(docs, "text_id")
    leaked = leaks.select(F.col("text_id").alias(key)).distinct()
    return with_text_id(docs, key).join(leaked, key, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids; see `packing.pack_documents`."""
    importable(spark)
    return packing.pack_documents(docs, tokenizer_path(), added=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", remove_repeated_strings),
    ("decontamination", remove_leaks),
    ("packing", pack),
]

# SQL can express neither the model, the groups, the sort nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

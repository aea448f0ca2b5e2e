"""Cleaning documents for training: language, near duplicates, repeated passages, packing.

Each stage works on all that the one before kept, as Parquet in between. Texts without a letter go, and those whose
code is far longer than usual for labelled texts of the language that fits best: junk and languages nobody labelled.
``lang`` becomes the predicted language (if no row has one, nothing is learned, and all texts with a letter stay);
of each class of near duplicates the one of the smallest id stays (rows without id all stay, repeated rows once);
repeated sentences go from all but their first document, whose row stays even if no text is left; the result is the
packed pieces of all documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, table
from tidemark.llm.language_id import known_language
from tidemark.llm.ngram_join import ngram_join
from tidemark.llm.packing import packed
from tidemark.llm.substring_dedup import substring_dedup
from tidemark.sources.staging import staged, staged_last

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates here are texts whose sets of word 5-grams have a Jaccard coefficient of 0.8 or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return known_language(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    classes = lambda: ngram_join(docs, NEAR_WORDS, NEAR_PERCENT, count_links=False).select(F.col("component_id").alias("kept"))
    # Staged as ids, so that nothing the join staged lies beside the later stages.
    kept = staged_last(lambda: classes().where("kept is not null").distinct(), "kept")
    rows = docs.select(*COLUMNS)
    named = rows.join(kept, F.col("doc_id") == F.col("kept"), "left_semi")
    # Of equal rows one stays.
    named = named.groupBy("doc_id", F.xxhash64("text").alias("_text")).agg(
        *[F.first(c).alias(c) for c in COLUMNS if c != "doc_id"]
    )
    return named.select(*COLUMNS).unionByName(rows.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    cleaned = substring_dedup(docs.select(*COLUMNS), "_removed")
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: SQL has no code lengths, sampled models or tokenizers: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus from ``documents``: five stages, each by one operator of ``cellferry.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellferry.llm import jaccard, language, packing, repeats, templates
from cellferry.llm.common import checkpointed
from cellferry.llm.queries import tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops null texts and texts without letters; others without a label get the predicted language.

    Where no label is there to learn from, documents with letters stay as they are.
    """
    learned = docs.select(F.col("doc_id").alias("id"), "text", "lang").where(~language.held_out("id"))
    model = language.fit(learned)
    if not model.languages:
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    told = language.predict(docs.select(*COLUMNS), model).where(F.col("lang_pred") != language.UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines whose template recurs, but its first; a document goes if nothing of it is left."""
    found = templates.recurring_lines(docs.select(*COLUMNS))
    left = found.where((F.col("n_dropped") == 0) | (F.trim("kept_text") != ""))
    return _with_text(left, F.col("kept_text"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group of near duplicates."""
    groups = jaccard.jaccard_groups(docs, words=5, percent=80)
    later = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(later, "doc_id", "left_anti").select(*COLUMNS)


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes strings of 100 bytes that start earlier too; a document goes if nothing of it is left."""
    found = repeats.without_repeats(docs, length=100, carry=("lang", "source", "n_chars"))
    left = found.where((F.col("n_removed") == 0) | (F.trim("kept_text") != ""))
    return _with_text(left, F.col("kept_text"))


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    return docs.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), length=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("lines", without_recurring_lines),
    ("near_duplicates", one_of_each_group),
    ("repeated_strings", without_repeated_strings),
    ("packing", packed),
]

# Regression weights, suffix order and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = checkpointed(docs)
    return docs

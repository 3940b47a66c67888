"""The checked queries: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ORACLES, QUERIES, bpe, fingerprints, jaccard, language, lattice, mixing, negatives, packing, prefixes, repeats, scoring, sql, templates, tokens,
)

Query = Callable[[SparkSession, str], DataFrame]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def with_sql(text: str) -> Callable[[Query], Query]:
    """Register a query beside its SQL."""

    def register(run: Query) -> Query:
        ORACLES[run.__name__] = text
        return query(run)

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"), limit=1024)


@query
def op6_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_decode(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


@query
def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", language.held_out().alias("held_out"))
    model = language.fit(docs.where(~F.col("held_out")).select(F.col("doc_id").alias("id"), "text", "lang"))
    return language.predict(docs.select("doc_id", "text", "held_out"), model).drop("text")


@query
def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), tokenizer("word_bpe_49k.json"), length=2048)


@query
def op3_lattice(spark: SparkSession, sf: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf, "embeddings"), least=0.9)


@query
def op10_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf, "documents"), words=5, percent=80)


@query
def op2_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf, "documents"))


@query
def op4_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf, "documents"), length=100)


@query
def op8_templates(spark: SparkSession, sf: str) -> DataFrame:
    found = templates.recurring_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.length("kept_text").cast("long").alias("kept_chars"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


@query
def op1_pseudo_likelihood(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score(table(spark, sf, "documents"))


@with_sql(sql.NEGATIVES)
def op11_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: negatives.floored(x * 256))
    given = vectors.select("vec_id", label.alias("label"), whole.alias("embedding"))
    found = negatives.hard_negatives(given, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100)
    return found.drop("positive_rank")


@with_sql(sql.MIXING)
def op12_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"), weights=(5, 2, 1), most=3).drop("repeats")


@with_sql(sql.PREFIXES)
def op13_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.prefix_tree(prefixes.with_shared_starts(table(spark, sf, "conversations"), group=20, most=4))

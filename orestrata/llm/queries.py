"""Registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.llm import (
    alignment,
    bpe,
    hamming,
    lexical,
    line_dedup,
    line_rules,
    mixing,
    near_dedup,
    passages,
    personal_data,
    quality,
    templates,
    toxicity,
)
from orestrata.llm.shared import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, folder)).select("doc_id", "class_id", "kept")


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return bpe.encoded(documents(spark, folder), path, public_tokenizers.PATTERN)


@query
def op3_quality_rff(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query
def op4_hamming_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector whose id is divisible by 20 asks all vectors."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return hamming.nearest(vectors, vectors.where("vec_id % 20 = 0"), bits=64)


@query
def op5_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = line_rules.judged(documents(spark, folder))
    return found.withColumn("cleaned_sha256", F.sha2("cleaned", 256)).drop("cleaned")


@query
def op6_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(documents(spark, folder))


@query
def op7_toxicity_crf(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query
def op8_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.classified(documents(spark, folder))
    return found.select("doc_id", "line", F.col("first_id").alias("first_doc_id"), "first_line", "kept")


@query
def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated(documents(spark, folder))


@query
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.found(documents(spark, folder))
    base = F.filter("found", lambda s: s["order"] < len(personal_data.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    mean = F.aggregate("found", F.lit(0.0), lambda a, s: a + s["score"])
    return found.select(
        "doc_id",
        *map(count, personal_data.KINDS),
        F.sha2(personal_data.joined(base), 256).alias("base_sha256"),
        personal_data.joined(F.col("found")).alias("spans"),
        F.round(mean, 6).alias("total_score"),
    )


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.aligned(documents(spark, folder), *paths)


@query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query
def op11_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return templates.extracted(spark.read.parquet(f"{folder}/pages.parquet"))

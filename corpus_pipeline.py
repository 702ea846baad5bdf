"""From raw documents to encoded training text, in five stages, each written as Parquet and read by the next.

1. quality: documents that the classifier rejects go.
2. lines: of each class of near-equal lines only the first stays; texts get shorter, no document goes.
3. near_dedup: one document of each class of near-equal documents stays.
4. mix: documents are repeated or left out so that sources meet their target weights.
5. encode: token ids of every text, with a check that they decode to it.

All but the last return the columns of `documents`. What a stage decides for odd rows is said by its operator.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orestrata.llm import bpe, line_dedup, mixing, near_dedup, quality
from orestrata.llm.queries import RANKS


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.cleaned(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes, and the ids as little-endian 32-bit numbers."""
    path = public_tokenizers.path(RANKS)
    return bpe.encoded(docs, path, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality", good_documents),
    ("lines", distinct_lines),
    ("near_dedup", distinct_documents),
    ("mix", target_mix),
    ("encode", token_ids),
]

# Classifier, signatures and token merges have no SQL form. No stage is compared with a plain version: a test runs them on the smallest
# tables and checks columns, ids and that token ids decode to the texts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, without the ids themselves (their digest stays)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{(base or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs.drop("ids")

"""Training corpus in stages, each an operator of the library applied to all rows before it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivel.llm.bpe import bpe_encode
from scrivel.llm.landing import landed
from scrivel.llm.line_quality import fit_line_field, line_quality
from scrivel.llm.mixing import mixed_documents
from scrivel.llm.queries import HELD_OUT
from scrivel.llm.secret_scan import redact_secrets
from scrivel.llm.simhash import simhash_dedup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents with a lower score are rejected.
LEAST_QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field, fitted to the labels that are not held out, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(f"NOT {HELD_OUT}")
    field = fit_line_field(docs, labels)
    return line_quality(docs, field, out="__score").filter(F.col("__score") >= LEAST_QUALITY).drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash_dedup(docs, "doc_id", "text", shingle=3, radius=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are masked, and their lengths counted again."""
    masked = redact_secrets(docs)
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind)).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix of their sources takes them."""
    return mixed_documents(docs, "doc_id", "text", "source", weights=(1, 2, 3), most=3, shards=16)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-pair ids instead of texts."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_encode(docs, ranks, public_tokenizers.PATTERN, "text", "ids").drop("text")
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: A fitted score, hashes of 64 bits and byte-pair merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents with a language, one of each group of near copies,
free of benchmark passages and secrets, packed into training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import read, stored
from sluice.llm.decontaminate import decontaminate
from sluice.llm.langid import language_stage
from sluice.llm.near_dedup import near_dedup_stage
from sluice.llm.packing import pack_documents
from sluice.llm.secrets import redact_stage
from sluice.llm.tokens import public_tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_stage(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup_stage(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_stage(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("benchmark_passages", benchmark_passages),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: The tokenizer and the prototypes have no SQL form; tests/llm/test_pipeline.py holds each
#: stage, and the whole run, against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the stored rows of the one before."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs

"""Corpus pipeline: raw documents to token ids, a stage an operator, each written as Parquet for the next."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

import eventloom  # noqa: E402
from eventloom.llm import decontamination, near_dups, pieces, quality, repeats  # noqa: E402
from eventloom.llm.batches import lean_batches  # noqa: E402
from eventloom.session import settle  # noqa: E402

# Executors need neither this folder nor an installed package.
cloudpickle.register_pickle_by_value(eventloom)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose posterior quality is high enough; the others go."""
    lean_batches(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more: the smallest id."""
    lean_batches(spark)
    return near_dups.keep_first(docs, shingle=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes or more that stand in two places; what is left empty goes."""
    lean_batches(spark)
    return repeats.cut_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window of ten words (or a whole shorter item); the others go."""
    lean_batches(spark)
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` with the end id and the text ``decoded`` from them."""
    lean_batches(spark)
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]

# The posterior of the quality rules, the chance of the forest and the tokenizer are beyond SQL; tests/llm holds the
# stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = settle(docs)
    return docs

"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read back by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import bpe, decontam, jaccard, passages, toxicity
from tickloom.llm.common import store, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the network scores 0.5 or more go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles and a similarity of 0.8 or more, the one with the smallest id stays."""
    return jaccard.one_of_each_group(docs, n=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are cut out of the text."""
    return passages.with_repeats_cut(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage like a benchmark item go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), arrays=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_benchmark_copies),
    ("BPE encoding", encode),
]

#: The stages learn a model, follow links and encode text; SQL cannot state them.  Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

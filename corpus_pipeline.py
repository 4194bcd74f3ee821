"""From raw documents to a training mix: five stages, each a Spark job over all that the one
before it kept. Stages are written as Parquet between them, so a lost executor costs at most
the stage it was working on."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import exact, leaks, mixing, near, quality
from parcelflow.llm.storage import read
from parcelflow.session import checkpoint_folder

NEAR_WORDS, NEAR_SHARE = 5, (80, 100)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network, fitted on labelled documents, does not reject."""
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is identical without white space."""
    return exact.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return near.drop_near_copies(docs, words=NEAR_WORDS, share=NEAR_SHARE)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, and how often."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("exact_dedup", without_exact_copies),
    ("near_dedup", without_near_copies),
    ("decontaminate", without_benchmark),
    ("mix", mixed_to_targets),
]

#: Learning and the hashed order of the mix are outside SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}

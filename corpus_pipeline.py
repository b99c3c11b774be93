"""From raw documents to shards of a training set: language, near copies, benchmark passages, mix, shards.

Every stage takes what the one before kept; all but the last return the columns of ``documents``. Each result is written
to the shared folder and read again, so a lost executor costs at most the tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmweave.llm import decontaminate, language, mixing, neardup, shards
from crmweave.llm.frames import stored, table, workers_find_package
from crmweave.session import configure

SHARDS = 16


def ready(spark: SparkSession) -> SparkSession:
    return workers_find_package(configure(spark))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without a letter, or without a lead for any, go."""
    ready(spark)
    return language.in_known_language(docs, language.learn(docs.filter(~language.held_out(F.col("doc_id")))))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8); documents without words stay."""
    ready(spark)
    return neardup.without_near_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.without_contaminated(docs, table(ready(spark), sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ready(spark)
    return mixing.mixed_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their shard and slot."""
    ready(spark)
    return shards.placed_rows(docs, SHARDS)


STAGES = [
    ("language", languages), ("near copies", near_copies), ("benchmark passages", benchmark_passages), ("mix", mix),
    ("shards", sharded),
]

# Similarity of sets, learned scores and seeded hashes are not in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs

"""A training corpus from documents: drop toxic texts, near copies and benchmark leaks, mix sources, and shard.

Each stage gets (spark, docs, folder of the tables) and returns a DataFrame, which is written and read
again before the next stage.  All but the last return the columns of documents; the last adds size, text_crc32, shard and
slot, and the slots of a shard are in the order of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from recordloom.llm.common import landed, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_first(docs, size=5, percent=80, unique_ids=False)


def reject_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, cap=None)


def shard_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The mix lies in its files in order; the slots of each shard follow it.
    return sharding.shard_in_order(mixing.stored_order(docs), ("_file", "_nth"))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", reject_leaks),
    ("source_mix", mix_sources),
    ("sharding", shard_rows),
]

#: Trained scores and the schedule of the mix have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

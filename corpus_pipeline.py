"""A training corpus from the documents table: toxic documents go, one of each
group of near duplicates stays, benchmark passages are cut out, domains are
mixed to target weights, and the rest is dealt into even shards.

Every stage takes ``(spark, docs, sf_dir)``, reads all that its predecessor kept
and returns a DataFrame, which :func:`run` writes as Parquet and reads again.
All but the last return the columns of ``documents``; the last adds ``size``,
``text_crc32``, ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm import decontaminate, mixing, shards, simhash, toxicity
from larch.llm.common import table, written

SHARDS = 8
#: Token shares of the labelled quality domains in the mixture.
QUALITY_TARGETS = {"high": 0.93, "low": 0.07}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    domain = F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), domain, QUALITY_TARGETS)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards.shard_documents(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("mixing", mix_domains),
    ("sharding", deal_shards),
]

#: Learnt scores, fingerprints, searches and rates: SQL cannot state the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

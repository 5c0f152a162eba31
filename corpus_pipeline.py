"""Corpus pipeline: quality classifier, SimHash near-dedup, benchmark decontamination, mixing, sharding.

Every stage calls one operator of ``orderflow.llm`` with production parameters on all that the stage before kept.
All but the last return the columns of the documents; mixing returns a row once for every copy it takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import decontaminate, gam, hashtree, mixing, simhash_tiles
from orderflow.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return gam.keep_quality(docs, gam.fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash_tiles.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is repeated as often as the mix takes it."""
    return mixing.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return hashtree.with_shards(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing to target weights", mixing_weights),
    ("sharding", sharding),
]
#: Boosting, fingerprints and Newton rounds have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

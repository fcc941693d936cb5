"""From raw documents to token files: five stages, each on all that the stage before kept.

Every stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns
a DataFrame, which is written as Parquet and read again for the next stage. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stepstream.llm.decontaminate import drop_contaminated
from stepstream.llm.mixing import take_mix
from stepstream.llm.quality_rules import keep_good
from stepstream.llm.simhash_dedup import drop_near_duplicates
from stepstream.llm.token_files import token_table
from stepstream.sources import read_table
from stepstream.workspace import new_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within four bits, over shingles of four words."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it: not at all, once or twice."""
    return take_mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold of each document."""
    return token_table(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

# Expectation-maximisation, fingerprints and tokens are not SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs

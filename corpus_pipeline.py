"""A corpus pipeline out of the operators in matchloom.llm: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchloom.llm.common import materialize, table
from matchloom.llm.decontamination import decontaminate
from matchloom.llm.language_id import keep_identified
from matchloom.llm.mixing import apply_mix
from matchloom.llm.near_duplicates import deduplicate
from matchloom.llm.sharding import apply_shards


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it."""
    return apply_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document of the mix, whole, and where it goes."""
    return apply_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Hash functions, edit distances and random rounding have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

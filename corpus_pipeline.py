"""Cleaning a corpus in stages; each stage works on all that its predecessor kept.

An id names a document: a stage drops documents by their ids, and rows without an id are
never dropped; but decontamination judges each row by its text, whatever its id. All stages but the last return the columns of the documents given, in their
order, other columns included. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trunkline.llm.common import stored, table
from trunkline.llm.decontamination import decontamination_stage
from trunkline.llm.exact_dedup import exact_dedup_stage
from trunkline.llm.jaccard_join import jaccard_stage
from trunkline.llm.packing import packing_stage
from trunkline.llm.toxicity import toxicity_stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity_stage(spark, docs, sf_dir)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts one stays."""
    return exact_dedup_stage(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the least id stays."""
    return jaccard_stage(spark, docs, sf_dir)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of benchmark items are cut out; documents with many of them go."""
    return decontamination_stage(spark, docs, sf_dir)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing_stage(spark, docs, sf_dir)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier and a tokenizer are not expressible in SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

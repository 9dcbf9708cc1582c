"""Corpus preparation: quality rules, near-dedup, personal data, best-fit packing.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage returns to the
shared folder and hands the next stage what it reads back. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weblathe.llm import neardup, packing, pii, quality
from weblathe.llm.common import Scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id."""
    return neardup.drop_copies(docs, percent=75)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; n_chars follows."""
    return pii.redact_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs, width=1024, end_id=2)


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("pii", pii_stage), ("packing", packing_stage)]

#: The stages are models and token counts, which SQL can't express; tests/llm hold run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline over ``documents``: each stage works on all that the one before kept.

``run`` writes every stage's rows to the shared folder and reads them again. All stages but the last give whole rows of
``documents``; the last gives each document's pieces and the text they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import decontam, exact, language, near, pieces
from vigil.llm.common import documents, stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without letters and doubtful ones go."""
    return language.accepted(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact.kept_rows(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the least id."""
    return near.kept_rows(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontam.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the piece ids of each text and the text they decode to."""
    return pieces.encode_and_decode(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", pieces_stage),
]
ORACLE_SQL = None  # neither the trained model nor the seeded segmentation can be written in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

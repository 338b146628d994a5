"""The corpus pipeline: five stages from ``documents`` to a mixed corpus.

Every stage takes (spark, docs, sf_dir) and works on all documents that its
predecessor kept; between stages the documents are written as Parquet and read
again, so a lost executor costs at most one stage.  All stages but the last
return the columns of ``documents``; the last adds ``copies``, how often the mix
takes the document.  The stages learn models and draw samples, which SQL cannot
express, so there is no ORACLE_SQL; tests hold the result against a plain
Python version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.llm.common import materialise, read_table
from kindred.llm.decontaminate import clean_documents
from kindred.llm.language_id import keep_identified
from kindred.llm.line_dedup import dedup_lines
from kindred.llm.mixing import mixed_documents
from kindred.llm.probminhash import keep_one

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go from all of them."""
    return dedup_lines(docs, min_docs=10, min_chars=1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken 0 to 3 times so that sources meet their weights."""
    return mixed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs

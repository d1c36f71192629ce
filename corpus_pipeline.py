"""Training-corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the columns of ``docs`` go through all
stages but the last, which returns the packed pieces. :func:`run` writes each stage's result as
Parquet below ``spark.checkpoint.dir`` and hands the files to the next stage.

Rows with NULLs: a NULL text has no language and goes in the first stage. A NULL doc_id is carried along:
it loses no lines, is nobody's duplicate, and is packed. Extra columns are kept untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from contrail.llm.common import documents, stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure."""
    return language_id.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line repeats."""
    return line_dedup.dedup_lines(docs, min_equal=line_dedup.MIN_EQUAL)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmark_free),
    ("packing", sequences),
]

#: compression, edit distance, tokenizer and packing have no SQL form; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

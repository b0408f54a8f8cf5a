"""The training-data pipeline: documents through quality rules, line dedup, near dedup and decontamination into packed sequences.

Each stage takes all rows that its predecessor kept, written as Parquet and read again, and returns documents with the
table's columns; the last one returns the packed pieces. A stage's decisions take effect: rejected, repeated and
contaminated documents go, and lines that are boilerplate leave the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import decontaminate, lines, near, packing, quality
from tidelog.llm.common import rows_of, saved
from tidelog.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, rows_of(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, rows_of(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Tokens, hashes and links can't be expressed in SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

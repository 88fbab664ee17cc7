"""The corpus pipeline: documents in, packed training sequences out.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; ``run`` writes
each stage's rows as Parquet in the shared folder and gives them to the next.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barwise.llm import decontaminate, langid, line_dedup, ngram_join, packing
from barwise.session import forget, scratch, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language (5)."""
    return langid.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line (10)."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles at 0.8 (6)."""
    return ngram_join.one_of_each(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages (1)."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 1024 tokens (8)."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                  ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmarks", benchmarks), ("sequences", sequences)]
#: Language models, set joins and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn.  A stage's tables go once its output is written, and so does the output before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        before = docs
        with scratch(spark) as keep:
            docs = keep(written(stage(spark, before, sf_dir), f"stage-{name}"))
        if i:
            forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)

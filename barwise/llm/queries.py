"""The registered queries of the training-data operators.

Each ``opN_<name>`` applies one operator, with production parameters, to its
whole table and derives the digest columns from the operator's rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.llm import (decontaminate, fingerprints, html_text, langid, licenses, line_dedup, merkle, ngram_join, packing, periodic_runs,
                         quality, retrieval_packing, sql, url_filter)
from barwise.llm.url_filter import Rule


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in every document, and who is contaminated."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of every document, by family."""
    return licenses.scan(table(spark, sf_dir, "documents"))


HOST_RULES = [Rule("com/", "allow"), Rule("example.com/en/", "block"), Rule("www.example.com/en/", "allow"), Rule("net/es/", "block"), Rule("net/fr/", "block")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages"), HOST_RULES + url_filter.PATTERNS).drop("url")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a quarter is held out."""
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles at 0.9: size of each document's set, and its group."""
    return ngram_join.near_groups(table(spark, sf_dir, "documents"), k=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a third is held out."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingles at 0.8: each document's lines, and the numbers of those removed."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of words that repeat with one period, in every document; a tenth has one planted."""
    return periodic_runs.report(table(spark, sf_dir, "documents"), periodic_runs.planted)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; a seventh is tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    hex_of = merkle.text_of
    proof = F.aggregate("path", F.lit(b""), lambda a, r: F.concat(a, r["others"]))
    return merkle.manifest(table(spark, sf_dir, "documents"), change=tampered).select(
        "doc_id", hex_of("leaf").alias("leaf"), hex_of("subroot").alias("subroot"), hex_of("root").alias("root"),
        F.sha2(hex_of(proof).cast("binary"), 256).alias("proof_sha256"), hex_of("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of up to 4096 tokens, next to lexical neighbours."""
    return retrieval_packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_licenses, op3_url_filter, op4_html_text, op5_language, op6_ngram_join,
                                   op7_fingerprints, op8_packing, op9_quality, op10_line_dedup, op11_periodic_runs, op12_merkle_manifest,
                                   op13_retrieval_packing)}
ORACLE_SQL = {"op1_decontamination": sql.OP1, "op3_url_filter": sql.OP3, "op12_merkle_manifest": sql.OP12}

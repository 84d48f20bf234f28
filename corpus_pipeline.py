"""The corpus pipeline: every stage takes (spark, docs, sf_dir) and returns what the next one reads.

Quality rules (operator 10) drop what they reject; the n-gram join (6) keeps one
document of each group of near copies (five words, similarity 0.8); secret scans
(2) replace secrets in the texts and drop nothing; packing (9) makes sequences.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from drivelake.llm import ngram_join, packing, quality_rules, secret_scan
from drivelake.llm.common import shared_path, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept(spark, docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(spark, docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ledger = shared_path(spark, "ledger")
    secret_scan.scan(spark, docs, ledger)
    return secret_scan.redacted(spark, docs, ledger)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_stage), ("near_duplicates", near_duplicate_stage), ("secrets", secret_stage), ("packing", packing_stage)]

#: Near copies could be had in SQL, token ids cannot.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), spark, f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus in five stages: quality rules, line dedup, near duplicates, decontamination, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns the
columns of `documents`; the last returns the packed sequences. A stage's result is written and read
again as the next one's input, so a lost executor costs at most one stage.

SQL cannot say the first and the last stage, so there is no SQL for the whole; tests compare the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillcast.llm.op2_quality_rules import kept_documents
from tillcast.llm.op3_ngram_join import distinct_documents
from tillcast.llm.op5_line_dedup import without_repeats
from tillcast.llm.op6_decontamination import decontaminated
from tillcast.llm.op9_best_fit_packing import best_fit
from tillcast.llm.registry import table
from tillcast.sources.staging import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go; every document stays."""
    return without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go from the texts."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with the sequences that hold them."""
    return best_fit(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

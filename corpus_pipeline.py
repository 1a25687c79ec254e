"""From raw documents to packed ones: every stage works on what its predecessor kept.

Each stage takes (spark, documents, folder of tables) and returns documents with the same columns; the
last returns the bins. Between stages, results are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewrank.llm import best_fit_packing, line_dedup, quality_rules, simhash_dedup, substring_dedup
from viewrank.llm.common import kept_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned quality rules keep."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that an earlier one holds."""
    return line_dedup.remove_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return simhash_dedup.first_of_each_group(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand elsewhere too."""
    return substring_dedup.remove_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of documents without conflicts."""
    return best_fit_packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("best-fit packing", packing),
]

# Learned rules, fingerprints and packing order are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

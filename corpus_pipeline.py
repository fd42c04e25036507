"""The corpus pipeline: quality rules, near-duplicates, decontamination, personal data, mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltscape.functions.staging import fresh_path, temporary
from voltscape.llm import decontaminate, mixing, pii, quality_rules, simhash
from voltscape.llm.common import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outlier of their language and source."""
    return quality_rules.good_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: shingles of 3 words, 3 bits."""
    return simhash.one_per_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what discloses it taken out of the text."""
    return pii.sanitised_rows(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("personal data", personal_data),
    ("mix", mixed),
]

#: SQL has no XXH64, covariance determinant or alignment: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each result is written once, and what a stage has written
    on its way goes with it. The last result stays until `staging.clear`."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        with temporary(spark):
            step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

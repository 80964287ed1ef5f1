"""A training corpus from the documents table: five stages, each over all that the one before kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the
shared folder and reads it back as the next stage's docs. All but the last stage return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordlens.llm import packing, quality, simhash, substring, tiling
from wordlens.llm.queries import tokenizer_path
from wordlens.session import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of SimHash near-duplicates."""
    return simhash.keep_one_per_group(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document has; documents that lose every word go."""
    return substring.remove_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold test items."""
    return tiling.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", good_documents),
    ("SimHash near-dedup", one_per_group),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: SQL can express neither the classifier nor the packing; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs

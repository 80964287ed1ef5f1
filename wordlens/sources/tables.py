"""Parquet table sources.

Reads name only the columns a query needs; Catalyst then prunes the Parquet read
schema and pushes filters into the scan (see ``explain``: ReadSchema, PushedFilters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def documents(spark: SparkSession, sf_dir: str, columns=("doc_id", "text")) -> DataFrame:
    return read_table(spark, sf_dir, "documents", columns)


def pages(spark: SparkSession, sf_dir: str, columns=("page_id", "url", "html")) -> DataFrame:
    return read_table(spark, sf_dir, "pages", columns)


def conversations(spark: SparkSession, sf_dir: str,
                  columns=("conv_id", "turn", "text")) -> DataFrame:
    return read_table(spark, sf_dir, "conversations", columns)


def events(spark: SparkSession, sf_dir: str,
           columns=("event_id", "user_id", "event_type")) -> DataFrame:
    return read_table(spark, sf_dir, "events", columns)

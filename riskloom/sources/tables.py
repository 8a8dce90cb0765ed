"""Table sources (S1, S3): Parquet tables by name, SQL over registered views."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full-table scan (S1).  Lazy: Catalyst prunes columns and pushes
    filters of whatever is built on top into the Parquet reader."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> None:
    """Register each table as a temporary view under its own name."""
    for n in names:
        if os.path.exists(table_path(sf_dir, n)):
            read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def execute_query(spark: SparkSession, query: str, args: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over registered views (S3); planning is Catalyst's.

    ``args`` are values of named markers (``:name``), bound as typed literals
    and never as text; a table or column name is bound by ``IDENTIFIER(:name)``.
    """
    return spark.sql(query, args=args) if args else spark.sql(query)

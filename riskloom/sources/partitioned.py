"""Tables laid out by ingestion date.

A table is a folder of ``ingest_date=YYYY-MM-DD`` partitions.  A date range
becomes a partition filter, so other days are neither listed nor opened; late
rows rewrite the days that they belong to and no others.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import as_date
from ..session import scratch_path
from .extract import training_extract

DATE_COL = "ingest_date"


def write_dates(df: DataFrame, path: str, ts_col: str, date_col: str = DATE_COL) -> str:
    """Writes ``df`` by the date of ``ts_col``: partitions that ``df`` has rows
    of are replaced, all others stay.  Rows are dealt by date and adaptive
    execution splits a day that holds much of the table over several tasks.
    Rows without a time go to the partition of missing dates."""
    dated = df.withColumn(date_col, F.to_date(ts_col))
    (dated.hint("rebalance", F.col(date_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))
    return path


def table_by_date(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The whole table; with its ``schema`` (the date column last) no file is
    opened to find it out."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def read_dates(spark: SparkSession, path: str, start=None, end=None, date_col: str = DATE_COL,
               schema: T.StructType | None = None) -> DataFrame:
    """The partitions of ``start`` to ``end`` (both inclusive, either optional)."""
    df = table_by_date(spark, path, schema)
    if start is not None:
        df = df.where(F.col(date_col) >= as_date(start))
    if end is not None:
        df = df.where(F.col(date_col) <= as_date(end))
    return df


def partition_extract(spark: SparkSession, path: str, start=None, end=None, limit: int | None = None,
                      where: str | list[str] | None = None, tie_col: str | None = None, ts_col: str = "ts",
                      date_col: str = DATE_COL, schema: T.StructType | None = None) -> DataFrame:
    """S2 over a table by date: only the partitions in range are read."""
    df = read_dates(spark, path, start, end, date_col, schema)
    return training_extract(df, ts_col, limit=limit, where=where, tie_col=tie_col).drop(date_col)


def rows_of_dates(spark: SparkSession, path: str, dates: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    """Rows of the days named by a table (its first column): the scan is pruned
    by that table's rows while the query runs (dynamic partition pruning)."""
    wanted = dates.select(F.col(dates.columns[0]).alias(date_col)).where(F.col(date_col).isNotNull()).distinct()
    return spark.read.parquet(path).join(wanted, date_col, "left_semi")


def merge_late(spark: SparkSession, path: str, late: DataFrame, key: str, ts_col: str,
               date_col: str = DATE_COL) -> list[dt.date]:
    """Adds late rows to a table by date: a late row takes the place of the row
    of its day that has its key.  Only the days of ``late`` are read and
    rewritten; returns them (a list as long as the days that changed)."""
    dated = late.withColumn(date_col, F.to_date(ts_col))
    days = sorted(r[0] for r in dated.where(F.col(date_col).isNotNull()).select(date_col).distinct().collect())
    held = spark.read.parquet(path).where(F.col(date_col).isin(days))
    kept = held.join(dated.select(date_col, key), [date_col, key], "left_anti")
    merged = kept.drop(date_col).unionByName(late)
    # The days are read from the folder that is written: the merged rows are a table of their own first.
    staged = scratch_path(spark, "late", uuid.uuid4().hex)
    merged.write.parquet(staged)
    write_dates(spark.read.schema(merged.schema).parquet(staged), path, ts_col, date_col)
    return days

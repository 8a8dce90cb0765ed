"""Table and dataset metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import bytes_to_mb
from .tables import read_table


def table_stats(df: DataFrame, name: str) -> DataFrame:
    """A1 + column count for one table: one aggregation."""
    return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                  F.lit(len(df.columns)).cast("long").alias("column_count"))


def file_bytes(df: DataFrame) -> DataFrame:
    """S8 size: bytes of the files behind a file-based DataFrame, from the
    hidden ``_metadata`` column (one row per distinct file, summed)."""
    files = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")).distinct()
    return files.agg(F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("size_bytes"))


def table_metadata(df: DataFrame, name: str) -> DataFrame:
    """Row count, bytes, MB (2 dp), column count, created / modified
    (oldest / newest file modification time) and the schema as an array of
    {name, type} — one pass: rows are counted per file first, then the
    per-file table (one row per file) is summed."""
    per_file = (df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"),
                          F.col("_metadata.file_modification_time").alias("m"))
                  .groupBy("p").agg(F.max("s").alias("s"), F.max("m").alias("m"), F.count(F.lit(1)).alias("n")))
    schema = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
                       for f in df.schema.fields])
    return per_file.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"),
        F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("size_bytes"),
        bytes_to_mb(F.coalesce(F.sum("s"), F.lit(0))).alias("size_mb"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.min("m").alias("created"),
        F.max("m").alias("modified"),
        schema.alias("schema"),
    )


def all_table_stats(spark: SparkSession, sf_dir: str, names) -> DataFrame:
    """S8/A1 for several tables as one DataFrame (a union of one-row aggregates)."""
    parts = [table_stats(read_table(spark, sf_dir, n), n) for n in names]
    return reduce(DataFrame.unionByName, parts)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Table count and names of a database (catalog metadata, small)."""
    tabs = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in tabs]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


def dataset_listing(spark: SparkSession, database: str | None = None) -> DataFrame:
    """S9 as one record: the database, its number of tables and their names."""
    tables = list_tables(spark, database)
    return tables.agg(F.lit(database or spark.catalog.currentDatabase()).alias("database"),
                      F.count(F.lit(1)).alias("table_count"), F.sort_array(F.collect_list("name")).alias("tables"))

"""Table health kept up by partition.

Every partition has one small row per column: rows, nulls, empties, and for
numbers count, smallest, largest, mean and squared deviation.  These rows merge
into the report of the whole table, so after an append or a rewrite only the
changed partitions are read again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import as_date, clamp_min, known, null_ratio, quality_assessment
from ..sources.partitioned import DATE_COL, table_by_date
from .quality import DEFAULT_LOOKBACK_DAYS, freshness_of_daily


def partition_states(df: DataFrame, date_col: str = DATE_COL, columns: list[str] | None = None) -> DataFrame:
    """One row per (partition, column): ``total_rows, nulls, empties`` (string
    columns only) and, for numbers, ``n_values, lowest, highest, mean, m2``
    (squared deviation from the mean).  NaN is a missing value."""
    fields = [f for f in df.schema.fields if f.name != date_col and (columns is None or f.name in columns)]

    def record(f: T.StructField):
        c = F.col(f"`{f.name}`")
        text = isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))
        x = known(c) if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")
        return F.struct(F.lit(f.name).alias("column_name"), c.isNull().alias("is_null"),
                        ((c.isNull() | (c == "")) if text else F.lit(None).cast("boolean")).alias("is_empty"), x.alias("x"))

    long = df.select(F.col(date_col), F.inline(F.array(*[record(f) for f in fields])))
    n = F.count("x")
    return long.groupBy(date_col, "column_name").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if("is_null").alias("nulls"),
        F.sum(F.when(F.col("is_empty"), 1).when(~F.col("is_empty"), 0)).cast("long").alias("empties"),
        n.alias("n_values"), F.min("x").alias("lowest"), F.max("x").alias("highest"), F.avg("x").alias("mean"),
        (F.var_pop("x") * n).alias("m2"))


def write_states(states: DataFrame, path: str, date_col: str = DATE_COL) -> str:
    """Replaces the states of the partitions in ``states``, and no others."""
    (states.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))
    return path


def refresh_states(spark: SparkSession, table_path: str, states_path: str, days: list[dt.date],
                   date_col: str = DATE_COL, columns: list[str] | None = None,
                   schema: T.StructType | None = None) -> str:
    """Reads the partitions ``days`` again and replaces their states; a day
    without rows any more has the state of no rows."""
    table = table_by_date(spark, table_path, schema)
    fresh = partition_states(table.where(F.col(date_col).isin(days)), date_col, columns)
    names = [c for c in table.columns if c != date_col and (columns is None or c in columns)]
    cells = spark.createDataFrame([(d, c) for d in days for c in names], f"{date_col} date, column_name string")
    whole = cells.join(fresh, [date_col, "column_name"], "left").fillna(0, ["total_rows", "nulls", "n_values"])
    return write_states(whole.select(fresh.columns), states_path, date_col)


def merge_states(states: DataFrame, digits: int = 6) -> DataFrame:
    """A8 + A9 of the whole table from its states: one row per column with
    ``total_rows, nulls, null_pct, empties, empty_pct, n_values, lowest,
    highest, mean, stddev``.  Deviations are put together around the common
    mean, which loses no digits where means are large."""
    sums = states.groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in ("total_rows", "nulls", "empties", "n_values")],
        F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
        F.try_divide(F.sum(F.col("mean") * F.col("n_values")), F.sum("n_values")).alias("mean"))
    around = states.join(sums.select("column_name", F.col("mean").alias("common")), "column_name")
    spread = around.groupBy("column_name").agg(
        F.sum(F.col("m2") + F.col("n_values") * F.pow(F.col("mean") - F.col("common"), 2)).alias("m2"))
    share = (lambda c: F.round(null_ratio(F.col(c) * 100.0, F.col("total_rows")), 2))
    return sums.join(spread, "column_name").select(
        "column_name", "total_rows", "nulls", share("nulls").alias("null_pct"), "empties", share("empties").alias("empty_pct"),
        "n_values", "lowest", "highest", F.round("mean", digits).alias("mean"),
        F.round(F.sqrt(null_ratio(F.col("m2"), F.col("n_values") - 1)), digits).alias("stddev"))


def quality_of_states(states: DataFrame) -> DataFrame:
    """A10 from states: ``total_rows, quality_score, assessment``."""
    share = null_ratio(F.sum("nulls") * 100.0, F.sum("total_rows"))
    columns = states.groupBy("column_name").agg(F.sum("total_rows").alias("total_rows"), F.round(share, 2).alias("null_pct"))
    one = columns.agg(F.coalesce(F.max("total_rows"), F.lit(0)).alias("total_rows"),
                      clamp_min(F.lit(100.0) - F.coalesce(F.avg(F.coalesce("null_pct", F.lit(0.0))), F.lit(0.0))).alias("score"))
    return one.select("total_rows", F.round("score", 2).alias("quality_score"),
                      F.when(F.col("total_rows") == 0, F.lit("No Data")).otherwise(quality_assessment("score")).alias("assessment"))


def freshness_of_states(states: DataFrame, as_of, lookback_days: int = DEFAULT_LOOKBACK_DAYS,
                        date_col: str = DATE_COL) -> DataFrame:
    """A11-A13 from states: a partition is a day."""
    days = states.groupBy(F.col(date_col).alias("date")).agg(F.max("total_rows").alias("row_count")).where("row_count > 0")
    return freshness_of_daily(days.where(F.col("date") >= F.date_sub(as_date(as_of), lookback_days)), as_of)

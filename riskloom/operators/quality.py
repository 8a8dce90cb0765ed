"""Table health: freshness, quality, duplicates, validation gate, null drop.

Every report is one aggregation plan that ends in a one-row DataFrame; the
verdict columns (status, assessment, is_valid) are computed inside the
plan, so nothing passes through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import (as_date, clamp_min, freshness_status, null_ratio,
                                quality_assessment, ts_bound)

# Fixed values that must equal the reference's.
DEFAULT_LOOKBACK_DAYS = 30
DEFAULT_MIN_ROWS = 1000
DEFAULT_MAX_NULL_FRACTION = 0.1


# ---------------------------------------------------------------- freshness

def daily_counts(df: DataFrame, ts_col: str, as_of, lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """A11 + P7: rows per calendar day for days >= as_of - lookback.

    The lower bound is applied to the raw timestamp so it reaches the
    Parquet scan as a pushed filter; grouping is a partial (map-side)
    aggregation, so a single hot day costs nothing extra.
    """
    lower = ts_bound(df, ts_col, F.date_sub(as_date(as_of), lookback_days))
    return (df.where(F.col(ts_col) >= lower)
              .groupBy(F.to_date(ts_col).alias("date"))
              .agg(F.count(F.lit(1)).alias("row_count")))


def freshness_summary(df: DataFrame, ts_col: str, as_of,
                      lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """A12 + A13: one row of freshness figures and the status verdict."""
    return freshness_of_daily(daily_counts(df, ts_col, as_of, lookback_days), as_of)


def freshness_of_daily(daily: DataFrame, as_of) -> DataFrame:
    """A12 + A13 from rows per day (``date, row_count``), however these were counted."""
    out = daily.agg(
        F.max("date").alias("latest_date"),
        F.min("date").alias("earliest_date"),
        F.round(F.avg("row_count"), 6).alias("avg_daily_rows"),
        F.round(F.stddev_samp("row_count"), 6).alias("stddev_daily_rows"),
        F.count(F.lit(1)).alias("days_with_data"),
        F.datediff(as_date(as_of), F.max("date")).alias("days_since_last_update"),
    )
    return out.withColumn("freshness_status", freshness_status("days_since_last_update"))


# ------------------------------------------------------------------ quality

def _is_string(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.StringType, T.VarcharType, T.CharType))


# Above this many columns the wide report is assembled from the long
# per-column profile, so no single generated aggregation grows with width.
WIDE_REPORT_COLUMNS = 300


def quality_report(df: DataFrame, columns: list[str] | None = None,
                   wide_limit: int = WIDE_REPORT_COLUMNS) -> DataFrame:
    """A8-A10 in one pass: per-column null counts and percentages, empty
    counts for string columns, the quality score and its assessment.

    Output columns: total_rows, {c}_nulls, {c}_null_pct, [{c}_empty,
    {c}_empty_pct], quality_score, assessment.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    if len(fields) > wide_limit:
        return _quality_report_from_profile(df, fields)
    total = F.count(F.lit(1))
    aggs = [total.alias("total_rows")]
    null_pct_names = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        n_null = F.count_if(c.isNull())
        aggs.append(n_null.alias(f"{f.name}_nulls"))
        aggs.append(F.round(null_ratio(n_null * 100.0, total), 2).alias(f"{f.name}_null_pct"))
        null_pct_names.append(f"{f.name}_null_pct")
        if _is_string(f):
            n_empty = F.count_if(c.isNull() | (c == ""))
            aggs.append(n_empty.alias(f"{f.name}_empty"))
            aggs.append(F.round(null_ratio(n_empty * 100.0, total), 2).alias(f"{f.name}_empty_pct"))
    wide = df.agg(*aggs)
    return _with_score(wide, null_pct_names)


def _with_score(wide: DataFrame, null_pct_names: list[str]) -> DataFrame:
    if null_pct_names:
        avg_null = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{n}`"), F.lit(0.0)) for n in null_pct_names]) / len(null_pct_names)
    else:
        avg_null = F.lit(0.0)
    score = clamp_min(F.lit(100.0) - avg_null)
    return (wide.withColumn("_score", score)
                .withColumn("quality_score", F.round("_score", 2))
                .withColumn("assessment", F.when(F.col("total_rows") == 0, F.lit("No Data"))
                            .otherwise(quality_assessment("_score")))
                .drop("_score"))


def _quality_report_from_profile(df: DataFrame, fields) -> DataFrame:
    """The wide report for wide tables: the long profile (one row per
    column, computed with per-row records and a partial aggregation) is
    pivoted into one row.  The pivot runs over a table with one row per
    column, so its size is bounded by the schema."""
    names = [f.name for f in fields]
    long = column_profile(df, names)
    piv = long.groupBy().pivot("column_name", names).agg(
        F.first("nulls").alias("nulls"), F.first("null_pct").alias("null_pct"),
        F.first("empties").alias("empty"), F.first("empty_pct").alias("empty_pct"),
        F.max("total_rows").alias("total"))
    cols = [F.coalesce(F.greatest(*[F.col(f"`{n}_total`") for n in names]), F.lit(0)).cast("long").alias("total_rows")]
    for f in fields:
        cols += [F.coalesce(F.col(f"`{f.name}_nulls`"), F.lit(0)).cast("long").alias(f"{f.name}_nulls"),
                 F.col(f"`{f.name}_null_pct`").alias(f"{f.name}_null_pct")]
        if _is_string(f):
            cols += [F.coalesce(F.col(f"`{f.name}_empty`"), F.lit(0)).cast("long").alias(f"{f.name}_empty"),
                     F.col(f"`{f.name}_empty_pct`").alias(f"{f.name}_empty_pct")]
    return _with_score(piv.select(*cols), [f"{f.name}_null_pct" for f in fields])


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A8 + A9 in long form — one row per column: nulls, null %, empties and
    empty % (string columns only; NULL otherwise).

    Each input row is turned into one small record per column inside the
    scan task (``inline`` of an array of structs) and aggregated partially
    before the shuffle, so the width of the table never becomes one huge
    generated expression: this is the form to use for wide schemas.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    recs = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"),
                 F.col(f"`{f.name}`").isNull().alias("is_null"),
                 (F.col(f"`{f.name}`").isNull() | (F.col(f"`{f.name}`") == "")).alias("is_empty")
                 if _is_string(f) else F.lit(None).cast("boolean").alias("is_empty"))
        for f in fields])
    long = df.select(F.inline(recs))
    total = F.count(F.lit(1))
    n_null = F.count_if(F.col("is_null"))
    n_empty = F.sum(F.when(F.col("is_empty"), 1).when(~F.col("is_empty"), 0))
    return (long.groupBy("column_name")
                .agg(total.alias("total_rows"), n_null.alias("nulls"),
                     F.round(null_ratio(n_null * 100.0, total), 2).alias("null_pct"),
                     n_empty.cast("long").alias("empties"),
                     F.round(null_ratio(n_empty * 100.0, total), 2).alias("empty_pct")))


# --------------------------------------------------------------- duplicates

def _missing(field: T.StructField) -> Column:
    """NULL, or NaN in a floating-point column: what ``isnull`` counts."""
    c = F.col(f"`{field.name}`")
    return c.isNull() | F.isnan(c) if isinstance(field.dataType, (T.FloatType, T.DoubleType)) else c.isNull()


def _typed_text(field: T.StructField) -> Column:
    """A cell as text that differs whenever the cell does: a mark for NULL,
    the length before each value, timestamps to the microsecond, binary as
    hexadecimal, nested values as JSON with microseconds."""
    c = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        text = F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))
    elif isinstance(kind, T.BinaryType):
        text = F.hex(c)
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(F.struct(c), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                                       "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    else:
        text = c.cast("string")
    return F.when(c.isNull(), F.lit("-;")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text, F.lit(";")))


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row's typed rendering: different whenever the row is, NULLs equal."""
    return F.sha2(F.concat(*[_typed_text(f) for f in df.schema.fields]), 256)


def _group_all(df: DataFrame, hashed: bool = False) -> DataFrame:
    """Distinct whole rows with their multiplicity (NULLs compare equal).

    A grouping on every column is a partial aggregation: copies are merged
    inside each map task before the shuffle, so one row repeated a billion
    times ships one record per task, not a billion.

    ``hashed=True`` groups on a SHA-256 digest of the row's typed rendering
    (``_typed_text``) instead, so only 32-byte keys are shuffled rather than whole rows
    (long texts included).  Two different rows share a digest with
    probability about n^2 / 2^257 — negligible, but not zero by
    construction, which is why the exact grouping is the default.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    null_count = reduce(lambda a, b: a + b,
                        [F.when(_missing(f), 1).otherwise(0) for f in df.schema.fields], F.lit(0))
    if hashed:
        return (df.select(row_digest(df).alias("_row"), null_count.alias("_nulls"))
                  .groupBy("_row")
                  .agg(F.count(F.lit(1)).alias("_copies"), F.max("_nulls").alias("_null_cells")))
    return (df.groupBy(*cols)
              .agg(F.count(F.lit(1)).alias("_copies"))
              .withColumn("_null_cells", null_count))


def row_profile(df: DataFrame, hashed: bool = False) -> DataFrame:
    """Total, unique (whole-row distinct) and duplicate rows."""
    g = _group_all(df, hashed)
    return g.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.lit(1)).alias("unique_rows"),
        (F.coalesce(F.sum("_copies"), F.lit(0)) - F.count(F.lit(1))).cast("long").alias("duplicate_rows"),
    )


def validation_gate(df: DataFrame, min_rows: int = DEFAULT_MIN_ROWS,
                    max_null_fraction: float = DEFAULT_MAX_NULL_FRACTION, hashed: bool = False) -> DataFrame:
    """A5 + A6 + A14 in one shuffle: row count, null-cell fraction,
    duplicate rows, column count and the validity verdict.

    Null cells are counted on the distinct-row table weighted by copies,
    so the duplicate count and the null fraction share one aggregation.
    """
    n_cols = len(df.columns)
    g = _group_all(df, hashed)
    rows = F.coalesce(F.sum("_copies"), F.lit(0)).cast("long")
    null_cells = F.coalesce(F.sum(F.col("_copies") * F.col("_null_cells")), F.lit(0))
    out = g.agg(
        rows.alias("row_count"),
        null_ratio(null_cells, rows * n_cols).alias("null_percentage"),
        (rows - F.count(F.lit(1))).alias("duplicate_rows"),
        F.lit(n_cols).alias("column_count"),
    )
    # The verdict compares the unrounded fraction; only the report is rounded.
    valid = (F.col("row_count") >= min_rows) & (F.coalesce(F.col("null_percentage"), F.lit(0.0)) <= max_null_fraction)
    return out.withColumn("is_valid", valid).withColumn("null_percentage", F.round("null_percentage", 6))


# ---------------------------------------------------------------- null drop

def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop every row holding a NULL (or NaN) in any column."""
    return df.na.drop(how="any")


def null_drop_report(df: DataFrame) -> DataFrame:
    """P4 count: rows before, rows after, rows removed — one pass."""
    any_null = reduce(lambda a, b: a | b, [_missing(f) for f in df.schema.fields], F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(~any_null).alias("rows_after_cleaning"),
        F.count_if(any_null).alias("removed_rows"),
    )


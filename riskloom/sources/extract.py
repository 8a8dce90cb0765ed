"""Filtered training extracts and training views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import date_range_predicate


def training_extract(df: DataFrame, ts_col: str, start_date=None, end_date=None, limit: int | None = None,
                     where: str | list[str] | None = None, tie_col: str | None = None) -> DataFrame:
    """Rows whose DATE(ts) lies in [start_date, end_date] (both
    inclusive, either optional), AND-ed with caller predicates, newest
    first, optionally the first ``limit`` rows (0 / None = all rows).

    The date bounds are written on the raw column so Parquet row groups are
    skipped; each caller predicate is parsed as its own expression, so
    ``a OR b`` cannot swallow the date bounds.  A LIMIT after ORDER BY is
    planned as a top-k (TakeOrderedAndProject), not a full sort.
    """
    d = df.where(date_range_predicate(df, ts_col, start_date, end_date))
    preds = [where] if isinstance(where, str) else list(where or [])
    for p in preds:
        d = d.where(F.expr(p))
    order = [F.col(ts_col).desc()]
    if tie_col:
        order.append(F.col(tie_col).desc())
    d = d.orderBy(*order)
    return d.limit(limit) if limit else d


def create_training_view(spark: SparkSession, source: DataFrame, view_name: str, feature_columns: list[str],
                         target_column: str, where: str | None = None) -> str:
    """K7: a view of the feature columns plus the target, optionally
    filtered.  An existing view of that name is kept (create-if-absent).
    Returns the view name."""
    if spark.catalog.tableExists(view_name):
        return view_name
    v = source.select(*feature_columns, target_column)
    if where:
        v = v.where(F.expr(where))
    v.createTempView(view_name)
    return view_name


def create_training_view_sql(spark: SparkSession, source_table: str, view_name: str, feature_columns: list[str],
                             target_column: str, where: str | None = None) -> str:
    """K7 for catalog tables: ``CREATE VIEW IF NOT EXISTS`` (persistent)."""
    cols = ", ".join(f"`{c}`" for c in [*feature_columns, target_column])
    q = f"CREATE VIEW IF NOT EXISTS {view_name} AS SELECT {cols} FROM {source_table}"
    if where:
        q += f" WHERE ({where})"
    spark.sql(q)
    return view_name

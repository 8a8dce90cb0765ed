"""Table health — metadata, duplicates, quality and freshness of one
table, each a one-row aggregation; the JSON report holds only those rows."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from ..sources import metadata


def table_health(df: DataFrame, name: str, ts_col: str | None = None, as_of=None) -> dict[str, DataFrame]:
    out = {
        "stats": metadata.table_metadata(df, name),
        "rows": quality.row_profile(df),
        "quality": quality.quality_report(df),
    }
    if ts_col is not None:
        out["freshness"] = quality.freshness_summary(df, ts_col, as_of)
    return out


def health_json(df: DataFrame, name: str, ts_col: str | None = None, as_of=None) -> str:
    """Each report is one row, so collecting them is bounded."""
    rep = {k: v.collect()[0].asDict(recursive=True) for k, v in table_health(df, name, ts_col, as_of).items()}
    return json.dumps(rep, indent=2, default=str)


def main(argv=None) -> str:
    """Command line: ``--operation stats | quality | freshness`` on one table."""
    import argparse

    ap = argparse.ArgumentParser(description="table health")
    ap.add_argument("--table", required=True, help="Parquet path or catalog table name")
    ap.add_argument("--operation", required=True, choices=["stats", "quality", "freshness"])
    ap.add_argument("--ts-column", help="timestamp column (freshness)")
    ap.add_argument("--as-of", help="today's date for freshness (default: current date)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    df = spark.read.parquet(a.table) if "/" in a.table else spark.table(a.table)
    name = a.table.rstrip("/").split("/")[-1]
    if a.operation == "stats":
        parts = {"stats": metadata.table_metadata(df, name), "rows": quality.row_profile(df)}
    elif a.operation == "quality":
        parts = {"quality": quality.quality_report(df)}
    else:
        if not a.ts_column:
            raise SystemExit("--ts-column is required for freshness")
        as_of = a.as_of or dt.date.today().isoformat()
        parts = {"freshness": quality.freshness_summary(df, a.ts_column, as_of)}
    # Each report is one row.
    doc = json.dumps({k: v.collect()[0].asDict(recursive=True) for k, v in parts.items()}, indent=2, default=str)
    print(doc)
    return doc


if __name__ == "__main__":
    main()

"""Sinks (K1-K5): prediction table, CSV, exports, JSON report, metric log."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import iso_timestamp
from ..operators.scoring import PREDICTION_SCHEMA, conform
from ..session import scratch_path
from .versioned import LoadRejected, replace_table, swap_folder

# Export format names accepted by ``export_table`` (case-insensitive), mapped
# to Spark data source names.  NEWLINE_DELIMITED_JSON is the long name of JSON.
EXPORT_FORMATS = {"CSV": "csv", "JSON": "json", "NEWLINE_DELIMITED_JSON": "json", "PARQUET": "parquet",
                  "ORC": "orc"}


def write_predictions(pred: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K1: replace the prediction table in a plain folder with rows in the
    fixed schema.  The new rows are written beside it and take its place when
    they are whole, so a load that fails leaves the old table.  Readers that
    must never see the moment in between use ``versioned.replace_table``."""
    staged = f"{path.rstrip('/')}__new_{uuid.uuid4().hex}"
    conform(pred, PREDICTION_SCHEMA).write.format(fmt).save(staged)
    swap_folder(pred.sparkSession, staged, path)
    return path


def replace_predictions(pred: DataFrame, path: str, min_rows: int = 0) -> int:
    """K1, atomic: predictions become the next version of the table at
    ``path`` (``versioned.read_table_version``) once their rows and schema
    have been checked; returns the version."""
    def enough(written: DataFrame) -> None:
        if written.count() < min_rows:
            raise LoadRejected(f"fewer than {min_rows} predictions")

    return replace_table(conform(pred, PREDICTION_SCHEMA), path, enough)


def save_predictions_table(pred: DataFrame, table: str) -> str:
    """K1 for catalog tables: the rows are written as a new table, which then
    takes the name; a load that fails leaves the old table."""
    spark, mark = pred.sparkSession, uuid.uuid4().hex
    conform(pred, PREDICTION_SCHEMA).write.saveAsTable(f"{table}__new_{mark}")
    had = spark.catalog.tableExists(table)
    if had:
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old_{mark}")
    spark.sql(f"ALTER TABLE {table}__new_{mark} RENAME TO {table}")
    if had:
        spark.sql(f"DROP TABLE {table}__old_{mark}")
    return table


def write_csv(df: DataFrame, path: str) -> str:
    """K2: CSV with a header row and no index column."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_table(df: DataFrame, path: str, format: str = "CSV") -> str:
    """K3: export as CSV / JSON (newline-delimited) / PARQUET (/ ORC)."""
    key = format.upper()
    if key not in EXPORT_FORMATS:
        raise ValueError(f"unsupported export format {format!r}; one of {sorted(EXPORT_FORMATS)}")
    w = df.write.mode("overwrite").format(EXPORT_FORMATS[key])
    if EXPORT_FORMATS[key] == "csv":
        w = w.option("header", True)
    w.save(path)
    return path


# Instances per request document: the reference's scoring page size.
INSTANCES_PER_DOCUMENT = 10000


def write_instance_documents(df: DataFrame, path: str, per_document: int = INSTANCES_PER_DOCUMENT) -> str:
    """S6 in reverse: rows as request documents ``{"instances": [...]}``, one
    document per line and many per file, read back by
    ``sources.files.read_instances(..., lines=True)``.

    Rows are numbered where they are read and every ``per_document`` of a task
    make a document, so an array never holds more, whatever the keys.  The
    numbered rows are a written table: a task that runs again finds the same
    numbers.
    """
    uid = F.monotonically_increasing_id()
    chunk = F.struct(F.shiftright("_uid", 33).alias("task"),
                     F.floor(F.col("_uid").bitwiseAND(2**33 - 1) / per_document).alias("part"))
    rows = df.select(uid.alias("_uid"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    numbered = scratch_path(df.sparkSession, "instances", uuid.uuid4().hex)
    rows.write.parquet(numbered)
    rows = df.sparkSession.read.schema(rows.schema).parquet(numbered)
    docs = rows.groupBy(chunk.alias("_doc")).agg(F.collect_list("_row").alias("instances"))
    docs.select(F.to_json(F.struct("instances")).alias("value")).write.mode("overwrite").text(path)
    return path


def write_report_json(report: DataFrame, path: str) -> str:
    """K4: the nested evaluation report as JSON."""
    report.write.mode("overwrite").json(path)
    return path


def metrics_map(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A map<string,double> column of the named metric columns (F9 input)."""
    cols = columns or df.columns
    return F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("double"))])


def performance_rows(metrics: DataFrame, model_name: str, version: str, logged_at=None,
                     columns: list[str] | None = None) -> DataFrame:
    """K5 row shape: model_name, version, timestamp (ISO text), metrics (JSON text)."""
    ts = F.current_timestamp() if logged_at is None else F.lit(logged_at).cast("timestamp")
    return metrics.select(F.lit(model_name).alias("model_name"), F.lit(version).alias("version"),
                          iso_timestamp(ts).alias("timestamp"),
                          F.to_json(metrics_map(metrics, columns)).alias("metrics"))


def log_performance(metrics: DataFrame, path: str, model_name: str, version: str, logged_at=None,
                    columns: list[str] | None = None) -> str:
    """K5: append one metrics row to the performance log table."""
    performance_rows(metrics, model_name, version, logged_at, columns).write.mode("append").parquet(path)
    return path

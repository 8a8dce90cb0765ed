"""File sources (S5-S7): CSV datasets, JSON instance documents, JSON lines."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

NO_INSTANCES = "a request document has no 'instances' array"


def read_csv_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Pass a schema in production; without one the
    schema is inferred (an extra pass over the files).  A cell that does not
    parse fails the read."""
    r = spark.read.option("header", True).option("mode", "FAILFAST")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_instances(spark: SparkSession, path: str, instance_schema: T.StructType | None = None,
                   lines: bool = False) -> DataFrame:
    """Documents shaped ``{"instances": [{feature: value, ...}, ...]}``
    -> one row per instance (``inline`` of the array).  A document without
    ``instances``, or one that does not parse, fails the read.  A file is one
    document; with ``lines`` every line is one, and large files are split."""
    r = spark.read.option("multiLine", not lines).option("mode", "FAILFAST")
    if instance_schema is not None:
        r = r.schema(T.StructType([T.StructField("instances", T.ArrayType(instance_schema))]))
    docs = r.json(path)
    if "instances" not in docs.columns:
        raise ValueError(NO_INSTANCES)
    given = F.when(F.col("instances").isNull(), F.raise_error(F.lit(NO_INSTANCES))).otherwise(F.col("instances"))
    return docs.select(F.inline(given))


class TooManyRejected(ValueError):
    """More lines than allowed do not parse."""


def read_jsonl_checked(spark: SparkSession, path: str, schema: T.StructType | str,
                       max_reject_share: float = 0.0) -> tuple[DataFrame, DataFrame, dict]:
    """S7 with a reject table: ``(accepted, rejected, counts)``.

    A line that is no JSON object, or holds a value that does not fit its
    column, is rejected whole (blank lines are none): ``rejected`` has its ``line`` and ``file``.
    ``counts`` has the lines read, accepted and rejected.  If the rejected
    share is over ``max_reject_share`` the job fails with both counts.  The
    lines are parsed once, into a table in the shared scratch folder.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bad, line = "_rejected", F.trim("value", F.lit(" \t\r\n"))
    parsed = F.from_json("value", T.StructType([*fields.fields, T.StructField(bad, T.StringType())]),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    lines = spark.read.text(path).where(line != "").select(
        "value", F.input_file_name().alias("file"), F.when(line.startswith("{"), parsed).alias("record"))
    folder = scratch_path(spark, "jsonl", uuid.uuid4().hex)
    whole = F.col("record").isNotNull() & F.col(f"record.{bad}").isNull()
    lines = lines.select(F.when(~whole, F.col("value")).alias("line"), "file", F.when(whole, F.col("record")).alias("record"))
    lines.write.parquet(folder)
    rows = spark.read.schema(lines.schema).parquet(folder)
    n = rows.agg(F.count(F.lit(1)).alias("read"), F.count("line").alias("rejected")).first()
    if n["rejected"] > max_reject_share * n["read"]:
        raise TooManyRejected(f"{n['rejected']} of {n['read']} lines of {path} do not parse "
                              f"(at most a share of {max_reject_share} is allowed)")
    accepted = rows.where(F.col("line").isNull()).select(*[F.col(f"record.`{f.name}`").alias(f.name) for f in fields])
    rejected = rows.where(F.col("line").isNotNull()).select("line", "file")
    return accepted, rejected, {"read": n["read"], "accepted": n["read"] - n["rejected"], "rejected": n["rejected"]}


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Newline-delimited JSON records (batch-prediction input).  A line
    that does not parse fails the read."""
    r = spark.read.option("mode", "FAILFAST")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)

"""M5 without repeats: a booking that arrives again, or a job that starts again,
leaves one scored row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.versioned import children, replace_table, manifest, read_table_version, delete


def first_arrivals(stream: DataFrame, key: str, ts_col: str, watermark: str = "1 day") -> DataFrame:
    """Drops rows whose key came before, within the watermark: the state holds
    the keys of that span and no more."""
    timed = stream.withColumn("_seen", F.col(ts_col).cast("timestamp")).withWatermark("_seen", watermark)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_seen")


def start_keyed_sink(stream: DataFrame, sink_path: str, checkpoint_path: str,
                     available_now: bool = True) -> StreamingQuery:
    """Each micro-batch is a folder of its own, written again if the batch
    runs again; ``read_keyed`` has one row per key, whatever was repeated."""
    def put(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    w = stream.writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint_path)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def batch_numbers(spark: SparkSession, sink_path: str) -> list[int]:
    return [int(n[6:]) for n, _ in children(spark, sink_path) if n.startswith("batch=") and n[6:].isdigit()]


def sink_rows(spark: SparkSession, sink_path: str) -> DataFrame:
    """All rows of a batch-folder sink with their ``batch``: those compacted
    and those of later batches."""
    held = manifest(spark, f"{sink_path}__compacted")
    upto = held["note"]["upto"] if held else -1
    later = [n for n in batch_numbers(spark, sink_path) if n > upto]
    parts = [read_table_version(spark, f"{sink_path}__compacted")] if held else []
    if later:
        new = spark.read.option("basePath", sink_path).parquet(*[f"{sink_path}/batch={n}" for n in later])
        parts.append(new.withColumn("batch", F.col("batch").cast("long")))
    if not parts:
        raise FileNotFoundError(f"{sink_path} holds no batch")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def latest_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with equal keys the one of the latest batch, its ``batch`` included."""
    figures = [c for c in rows.columns if c not in keys and c != "batch"]
    last = rows.groupBy(*keys).agg(F.max("batch").alias("batch"), F.max_by(F.struct(*figures), "batch").alias("_last"))
    return last.select(*keys, "batch", *[F.col(f"_last.`{c}`").alias(c) for c in figures])


def read_keyed(spark: SparkSession, sink_path: str, keys: list[str]) -> DataFrame:
    """One row per key: that of the latest batch that wrote it."""
    return latest_rows(sink_rows(spark, sink_path), keys).drop("batch")


def compact(spark: SparkSession, sink_path: str, keys: list[str]) -> int:
    """Puts the latest row of every key into one table behind a pointer and
    deletes the batch folders that it covers; returns the last batch covered.
    A failure before the pointer moves changes nothing; folders left over by
    one after it are covered already, and go with the next call."""
    numbers = batch_numbers(spark, sink_path)
    held = manifest(spark, f"{sink_path}__compacted")
    upto = held["note"]["upto"] if held else -1
    if max(numbers, default=-1) > upto:
        upto = max(numbers)
        replace_table(latest_rows(sink_rows(spark, sink_path), keys), f"{sink_path}__compacted", note={"upto": upto})
    for n in numbers:
        if n <= upto:
            delete(spark, f"{sink_path}/batch={n}")
    return upto

"""M6: streaming monitors — event volume and error rate per event-time
window, late rows bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .once import compact, read_keyed


def windowed_monitor(events: DataFrame, ts_col: str = "ts", type_col: str = "event_type",
                     window: str = "1 day", watermark: str = "1 hour", error_value: str = "error") -> DataFrame:
    """Per tumbling event-time window: events, errors, error rate.

    Driver Parquet timestamps are ``timestamp_ntz``, which watermarks do not
    accept, so the event time is cast to ``timestamp`` (session time zone
    UTC).  State per window is dropped once the watermark passes its end;
    rows later than that are ignored.
    """
    e = events.withColumn("_et", F.col(ts_col).cast("timestamp")).withWatermark("_et", watermark)
    is_err = F.col(type_col) == error_value
    g = e.groupBy(F.window("_et", window).alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(is_err).alias("n_errors"),
        F.round(F.avg(F.when(is_err, 1.0).otherwise(0.0)), 6).alias("error_rate"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_events", "n_errors", "error_rate")


WINDOW_KEYS = ("window_start", "window_end")


def start_monitor_sink(monitor: DataFrame, sink_path: str, checkpoint_path: str,
                       available_now: bool = True) -> StreamingQuery:
    """Every window that a micro-batch changed is written to that batch's own
    folder (overwritten if the batch runs again), the running window included;
    ``read_monitor`` gives the latest row of each window, and
    ``compact_monitor`` keeps the number of folders small."""
    def upsert(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    w = monitor.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_monitor(spark: SparkSession, sink_path: str, keys=WINDOW_KEYS) -> DataFrame:
    """The state of every window (and bin, if ``keys`` says so) after the last
    batch that changed it."""
    return read_keyed(spark, sink_path, list(keys))


def compact_monitor(spark: SparkSession, sink_path: str, keys=WINDOW_KEYS) -> int:
    """Replaces the batch folders so far by one table of latest rows."""
    return compact(spark, sink_path, list(keys))

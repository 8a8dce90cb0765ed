"""M1 as a stream: scores meet labels that arrive later, with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import null_ratio


def labelled_scores(scores: DataFrame, labels: DataFrame, key: str, ts_col: str, label_ts_col: str, label_col: str,
                    within: str = "90 days", watermark: str = "1 day") -> DataFrame:
    """Every scored row once, with its label if that comes no later than
    ``within`` after the score, else with NULL.

    A stream-stream left outer join: both sides carry a watermark and the
    condition bounds the label's time from both sides, so a score leaves the
    state when its label can no longer come, and a label when no score can.
    Rows are given out when that is decided.
    """
    s = scores.withColumn("_scored", F.col(ts_col).cast("timestamp")).withWatermark("_scored", watermark)
    la = labels.select(F.col(key).alias("_key"), F.col(label_ts_col).cast("timestamp").alias("_known"),
                       F.col(label_col)).withWatermark("_known", watermark)
    timely = (F.col(key) == F.col("_key")) & (F.col("_known") >= F.col("_scored")) & F.expr(
        f"_known <= _scored + INTERVAL {within}")
    return s.join(la, timely, "leftOuter").drop("_key", "_scored", "_known")


def accuracy_of_labelled(rows: DataFrame, ts_col: str, label_col: str, pred_col: str = "fraud_prediction",
                         unit: str = "month") -> DataFrame:
    """The figures of ``accuracy_trend`` from rows that carry their label."""
    y, p = F.col(label_col), F.col(pred_col)
    return rows.groupBy(F.date_trunc(unit, F.col(ts_col)).alias("period")).agg(
        F.count(F.lit(1)).alias("n_predictions"), F.count_if(y.isNotNull()).alias("n_labelled"),
        F.count_if(y.isNull()).alias("unlabelled"),
        F.round(null_ratio(F.count_if(y == p), F.count_if(y.isNotNull())), 6).alias("accuracy"))


def closing_row(like: DataFrame, ts_col: str, at: str) -> DataFrame:
    """One row of the frame's schema, all NULL but the time ``at``: at the end
    of a finite stream it moves the watermark past everything before it.  A
    NULL key joins with nothing."""
    spark = like.sparkSession
    return spark.range(1).select(*[(F.lit(at) if f.name == ts_col else F.lit(None)).cast(f.dataType).alias(f.name)
                                   for f in like.schema])


def start_labelled_sink(rows: DataFrame, sink_path: str, checkpoint_path: str,
                        available_now: bool = True) -> StreamingQuery:
    w = (rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_path))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start(sink_path)

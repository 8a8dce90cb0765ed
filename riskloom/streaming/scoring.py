"""M5: streaming scoring — a file stream scored by the same stateless
transform as batch scoring, written append-only with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import models, scoring


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stream_predictions(stream: DataFrame, id_col: str = "booking_id", model=None,
                       scorer: Callable[[DataFrame], DataFrame] | None = None, scored_at=None) -> DataFrame:
    """Rows of the fixed prediction schema from a streaming frame, scored by
    a fitted ``PipelineModel`` or by any column-wise ``scorer`` that adds
    ``fraud_probability``.  Stateless: no watermark needed."""
    if (model is None) == (scorer is None):
        raise ValueError("give exactly one of model / scorer")
    scored = models.score(model, stream) if model is not None else scorer(stream)
    ts = F.current_timestamp() if scored_at is None else scored_at
    return scoring.prediction_rows(scored, id_col, F.col("fraud_probability"), ts)


def start_parquet_sink(stream: DataFrame, sink_path: str, checkpoint_path: str,
                       available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Append to Parquet with a checkpoint (exactly-once file sink)."""
    w = (stream.writeStream.format("parquet").outputMode("append")
               .option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start(sink_path)

"""Soft-vote ensemble scoring and the prediction table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import RISK_LABELS, known, risk_tier

# Fixed sink schema (the reference's prediction table).
PREDICTION_SCHEMA = T.StructType([
    T.StructField("booking_id", T.StringType()),
    T.StructField("fraud_probability", T.DoubleType()),
    T.StructField("fraud_prediction", T.LongType()),
    T.StructField("risk_category", T.StringType()),
    T.StructField("prediction_timestamp", T.TimestampType()),
])

# A soft-vote predicts class 1 only when the mean P(1) is strictly above this
# (argmax over [P(0), P(1)] resolves a tie to class 0).
VOTE_THRESHOLD = 0.5


def soft_vote(members: list, digits: int | None = None) -> Column:
    """Mean of the members' P(class 1), NULL if a member's is missing
    (NULL or NaN).  ``digits`` rounds the mean."""
    cols = [known(m) for m in members]
    mean = reduce(lambda a, b: a + b, cols) / F.lit(float(len(cols)))
    return F.round(mean, digits) if digits is not None else mean


def vote_class(prob) -> Column:
    p = known(prob)
    # A missing score (NULL, NaN) has no class; it is not "class 0".
    return F.when(p > VOTE_THRESHOLD, F.lit(1)).when(p.isNotNull(), F.lit(0)).cast("long")


def prediction_rows(df: DataFrame, id_col: str, prob: Column, scored_at) -> DataFrame:
    """L8 + P9 + P10: rows in the fixed prediction schema.

    ``scored_at`` is the prediction timestamp (a literal or a Column such
    as ``current_timestamp()``); the key is carried through, no positional
    re-attachment.
    """
    ts = scored_at if isinstance(scored_at, Column) else F.lit(scored_at)
    d = df.select(F.col(id_col).cast("string").alias("booking_id"), known(prob).alias("fraud_probability"))
    return d.select(
        "booking_id", "fraud_probability",
        vote_class("fraud_probability").alias("fraud_prediction"),
        risk_tier("fraud_probability").alias("risk_category"),
        ts.cast("timestamp").alias("prediction_timestamp"),
    )


def conform(df: DataFrame, schema: T.StructType = PREDICTION_SCHEMA) -> DataFrame:
    """P10: select and cast to a fixed schema, in the schema's column order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def prediction_summary(pred: DataFrame) -> DataFrame:
    """Totals, predicted frauds, rows per tier and mean probability."""
    r = F.col("risk_category")
    return pred.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.coalesce(F.sum("fraud_prediction"), F.lit(0)).cast("long").alias("fraud_predictions"),
        *[F.count_if(r == t).alias(f"n_{t.lower()}") for t in RISK_LABELS],
        F.round(F.avg("fraud_probability"), 6).alias("avg_fraud_probability"),
    )


def risk_tier_counts(pred: DataFrame) -> DataFrame:
    """Rows per risk tier (value_counts)."""
    return pred.groupBy("risk_category").agg(F.count(F.lit(1)).alias("n"))

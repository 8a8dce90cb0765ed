"""Tables derived from the driver tables with Spark.

The reference reads a wide ``booking`` table (``booking_id``, ``fraud_flag``
and numeric features).  The driver data has none, so a surrogate is derived
from ``orders`` and per-order ``lineitem`` aggregates; its size grows with
the inputs like any other job here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_COL = "booking_id"
LABEL_COL = "fraud_flag"
FEATURES = ("total_price", "n_items", "qty_sum", "avg_discount", "price_sum")
MEMBER_SCORES = ("score_lr", "score_xgb", "score_lgb")


def order_features(lineitem: DataFrame) -> DataFrame:
    """Per-order aggregates.  Partial aggregation merges each order's lines
    inside the map task, so a hot order key ships one record per task."""
    return (lineitem.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.sum("l_quantity").alias("qty_sum"),
                 F.round(F.avg("l_discount"), 6).alias("avg_discount"),
                 F.round(F.sum("l_extendedprice"), 2).alias("price_sum")))


def booking(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Surrogate ``booking``: one row per order that has lines.

    ``fraud_flag`` is a rule on the features, flipped for about 1/16 of
    the keys by an md5 digit (label noise, so no model is perfect).
    Orders are unique per key and the lineitem side is pre-aggregated to
    one row per key, so the join is a skew-free equi-join on the key.
    """
    o = orders.select("o_orderkey", "o_totalprice")
    li = order_features(lineitem)
    bid = F.col("o_orderkey").cast("string")
    rule = (F.col("qty_sum") > 130) & (F.col("avg_discount") > 0.05)
    noise = F.substring(F.md5(F.concat(F.lit("f:"), bid)), 1, 1) == "0"
    return (o.join(li, o.o_orderkey == li.l_orderkey, "inner")
             .select(bid.alias(ID_COL),
                     F.col("o_totalprice").alias("total_price"),
                     "n_items", "qty_sum", "avg_discount", "price_sum",
                     F.when(rule != noise, 1).otherwise(0).cast("int").alias(LABEL_COL)))


def _logistic(z: Column) -> Column:
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6)


def member_scores(df: DataFrame) -> DataFrame:
    """Three fixed scorers (deterministic logistic formulas of the features).

    They stand in for fitted ensemble members wherever an operator must be
    checked against SQL: the operator under test is the same one the fitted
    path uses, only the member probabilities are fixed.
    """
    q, d, n, p = (F.col("qty_sum"), F.col("avg_discount"), F.col("n_items"), F.col("price_sum"))
    return df.select(
        "*",
        _logistic(0.04 * (q - 130) + 60.0 * (d - 0.05)).alias("score_lr"),
        _logistic(0.6 * (n - 5) + 30.0 * (d - 0.05)).alias("score_xgb"),
        _logistic(0.00002 * (p - 250000) + 0.02 * (q - 130)).alias("score_lgb"),
    )


def orders_with_gaps(orders: DataFrame) -> DataFrame:
    """``orders`` with NULLs and empty strings made on purpose (the driver
    tables have none): status 'P' -> NULL, priority '5-LOW' -> '',
    total price under 5000 -> NULL."""
    return orders.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 5000, F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def doc_scores(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """Second surrogate: ``toxic`` label scored by document length."""
    return (labels.join(documents.select("doc_id", "n_chars"), "doc_id", "inner")
                  .select("doc_id", F.col("toxic").cast("int").alias("label"),
                          F.col("n_chars").cast("double").alias("score")))

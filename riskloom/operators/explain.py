"""O4 for one prediction: what each feature adds to a row's raw score.

A tree's prediction is its root's value plus, at each step of the row's path,
the change of value from a node to its child, which is credited to the feature
that the node asks about.  A boosted member adds its trees up by weight; the
logistic member adds coefficient times value to its intercept.  Base and
contributions sum to the raw score of every row and member.

The trees come from the saved model's node tables as one row of bounded size
(the model's own); a task walks each tree with a batch of rows at a time, in as
many array steps as the tree is deep, so no row is repeated per tree.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .models import MEMBERS, VECTOR, model_features

BASE = "(base)"


def saved_trees(spark, stage_path: str) -> DataFrame:
    """One row: ``trees``, per tree its weight and its nodes by number
    (``feature`` -1 for leaves, ``threshold``, ``left``, ``right``, ``value``)."""
    n = F.col("nodeData")
    node = F.struct(n["id"].alias("id"), n["split"]["featureIndex"].alias("feature"),
                    F.try_element_at(n["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
                    n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("value"))
    nodes = (spark.read.parquet(os.path.join(stage_path, "data")).groupBy("treeID")
             .agg(F.sort_array(F.collect_list(node)).alias("nodes")))
    weights = spark.read.parquet(os.path.join(stage_path, "treesMetadata")).toDF("treeID", "metadata", "weight").drop("metadata")
    return nodes.join(weights, "treeID").agg(F.collect_list(F.struct("treeID", "weight", "nodes")).alias("trees"))


def walked(x: np.ndarray, trees: list[tuple], depth: int) -> np.ndarray:
    """Per row of ``x`` the base and each feature's contribution, NaN for those
    that no path of the row asks about; ``trees``: weight and node columns."""
    n, width = x.shape
    base, rows = np.zeros(n), np.arange(n) * (width + 1)
    out, asked = np.zeros(n * (width + 1)), np.zeros(n * (width + 1), dtype=bool)
    flat, cells = x.ravel(), np.arange(n) * width
    for weight, feature, threshold, left, right, value in trees:
        base += weight * value[0]
        at = np.zeros(n, dtype=np.int64)
        for _ in range(depth):
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            to = np.where(flat[cells + np.maximum(f, 0)] <= threshold[at], left[at], right[at])
            to = np.where(inner, to, at)
            place = rows + f + 1  # a leaf adds nothing to the base's place
            out[place] += weight * (value[to] - value[at])
            asked[place] = True
            at = to
    out, asked = out.reshape(n, width + 1), asked.reshape(n, width + 1)
    out[~asked] = np.nan
    out[:, 0] = base
    return out


def tree_contributions(rows: DataFrame, trees: DataFrame, depth: int, key: str) -> DataFrame:
    """``key, position, contribution`` (position -1: the base) of a boosted
    member; ``rows``: ``key`` (unique) and the feature array ``x``."""
    # One row per model: its nodes go to the tasks with the function.
    model = []
    for t in trees.first()["trees"] or []:
        column = {c: [n[c] for n in t["nodes"]] for c in ("feature", "threshold", "left", "right", "value")}
        model.append((t["weight"], np.array(column["feature"]),
                      np.array([np.nan if v is None else v for v in column["threshold"]], dtype=float),
                      np.array(column["left"]), np.array(column["right"]), np.array(column["value"], dtype=float)))

    @F.pandas_udf("array<double>")
    def contributions(x: pd.Series) -> pd.Series:
        return pd.Series(list(walked(np.vstack(x.to_list()), model, depth)) if len(x) else [], dtype=object)

    long = rows.select(key, F.posexplode(contributions("x")).alias("_place", "contribution")).where(~F.isnan("contribution"))
    return (long.groupBy(key, (F.col("_place") - 1).alias("position")).agg(F.sum("contribution").alias("contribution")))


def explanations(spark, model: PipelineModel, model_path: str, df: DataFrame, key: str = "booking_id") -> DataFrame:
    """``key, member, feature, contribution`` of every row, feature ``(base)``
    for what no feature adds; a boosted member's features that a row's paths
    never ask about have no row."""
    names = model_features(model)
    rows = model.stages[0].transform(df).select(key, vector_to_array(VECTOR).alias("x"))
    lr = model.stages[1]
    terms = F.array(F.struct(F.lit(-1).alias("position"), F.lit(float(lr.intercept)).alias("contribution")),
                    *[F.struct(F.lit(k).alias("position"), (F.col("x")[k] * float(c)).alias("contribution"))
                      for k, c in enumerate(lr.coefficients.toArray())])
    parts = [rows.select(key, F.lit("lr").alias("member"), F.inline(terms))]
    for place, member in ((2, "xgb"), (3, "lgb")):
        stage = model.stages[place]
        trees = saved_trees(spark, os.path.join(model_path, "stages", f"{place}_{stage.uid}"))
        depth = max((t.depth for t in stage.trees), default=0)
        found = tree_contributions(rows, trees, depth, key)
        parts.append(found.select(key, F.lit(member).alias("member"), "position", "contribution"))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    feature = F.when(F.col("position") < 0, F.lit(BASE)).otherwise(
        F.element_at(F.array(*[F.lit(n) for n in names]), (F.greatest(F.col("position"), F.lit(0)) + 1).cast("int")))
    return every.select(key, "member", feature.alias("feature"), "contribution")


def raw_scores(model: PipelineModel, df: DataFrame, key: str = "booking_id") -> DataFrame:
    """``key, member, raw``: the margin of class 1 of every member."""
    out = model.transform(df)
    return out.select(key, F.inline(F.array(*[
        F.struct(F.lit(m).alias("member"), vector_to_array(F.col(f"_raw_{m}"))[1].alias("raw")) for m in MEMBERS])))


def top_reasons(explained: DataFrame, k: int = 3, key: str = "booking_id") -> DataFrame:
    """The ``k`` features that move each member's score of a row most, ties by name."""
    order = Window.partitionBy(key, "member").orderBy(F.desc(F.abs("contribution")), "feature")
    return (explained.where(F.col("feature") != BASE).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))

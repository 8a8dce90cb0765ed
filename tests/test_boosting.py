"""Boosted members grown in one barrier stage (L3, L4) and their explanations."""

import os

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import boosting, explain, models


def rows_of(spark, n=600):
    x = F.xxhash64
    return spark.range(n).select(
        F.col("id").cast("string").alias("booking_id"), F.pmod(x("id"), F.lit(9)).cast("double").alias("a"),
        F.pmod(x("id", F.lit(1)), F.lit(13)).cast("double").alias("b"), F.lit(2.0).alias("c"),
        (F.pmod(x("id"), F.lit(9)) * 3 + F.pmod(x("id", F.lit(1)), F.lit(13)) + F.pmod(x("id", F.lit(2)), F.lit(11)) > 24)
        .cast("int").alias("fraud_flag"))


def test_trees_are_those_of_mllib(spark):
    df = rows_of(spark)
    n1 = df.where("fraud_flag = 1").count()
    train = models.training_frame(df, "fraud_flag", 600 - n1, n1)
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="_features").transform(train).repartition(3).persist()
    est = GBTClassifier(featuresCol="_features", labelCol="_label", weightCol="_w_pos", maxIter=6, maxDepth=3, stepSize=0.3,
                        minInstancesPerNode=5, seed=1)
    ours, theirs = boosting.fit_boosted(ready, [est], 3, (600 - n1) / n1)[0], est.fit(ready)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees]
    assert ours.getStepSize() == 0.3 and ours.treeWeights == theirs.treeWeights
    margins = [[r[0] for r in m.transform(ready).orderBy("booking_id").select(vector_to_array("rawPrediction")[1]).collect()]
               for m in (ours, theirs)]
    assert np.allclose(*margins, atol=1e-9)
    ready.unpersist()


def test_a_fit_runs_few_jobs(spark):
    """Before: a job per level, round and member (here over 200)."""
    sc = spark.sparkContext
    sc.setJobGroup("boosting-jobs", "fit")
    try:
        model = models.fit_ensemble(rows_of(spark), ["a", "b", "c"], "fraud_flag", rounds=20, lr_max_iter=5)
    finally:
        sc.setJobGroup("", "")
    assert len(sc.statusTracker().getJobIdsForGroup("boosting-jobs")) < 100
    assert model.stages[2].getNumTrees == model.stages[3].getNumTrees == 20


def test_cut_points():
    assert boosting.cut_points([3, 1, 1, 2], [1, 1, 1, 1], 32) == [1.5, 2.5]
    assert boosting.cut_points([5, 5], [1, 2], 32) == []
    cuts = boosting.cut_points(np.arange(1000), np.ones(1000), 32)
    assert len(cuts) == 31 and cuts == sorted(cuts) and max(np.diff(cuts)) < 34


def test_explanations_do_not_repeat_rows_per_tree(spark, tmp_dir):
    df = rows_of(spark, 200)
    model = models.fit_ensemble(df, ["a", "b", "c"], "fraud_flag", rounds=3, lr_max_iter=5)
    path = models.save_model(model, os.path.join(tmp_dir, "m"))
    found = explain.explanations(spark, model, path, df)
    assert "explode(trees" not in found._jdf.queryExecution().toString()
    sums = found.groupBy("booking_id", "member").agg(F.sum("contribution").alias("explained"))
    both = explain.raw_scores(model, df).join(sums, ["booking_id", "member"])
    assert both.count() == 600 and both.where("abs(raw - explained) > 1e-9").count() == 0

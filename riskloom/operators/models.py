"""Fitted ensemble on ``pyspark.ml``.

Three members — a class-balanced logistic regression and two boosted-tree
models weighted by n0/n1 — are stages of one ``Pipeline`` so a single
``PipelineModel`` saves, loads and scores them together.  Scoring is one
``transform``; the soft vote is the same column expression the fixed-score
queries use.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..session import scratch_path
from . import importance as imp
from .boosting import fit_boosted
from .prep import class_counts, require_columns, require_numeric
from .scoring import soft_vote, vote_class

MEMBERS = ("lr", "xgb", "lgb")
VECTOR = "_features"

# Settings that mirror the reference's member models.
DEFAULTS = dict(
    rounds=100,          # boosting rounds (n_estimators)
    depth=6,             # max tree depth
    lr_max_iter=1000,    # logistic iterations
    seed=42,             # random_state
    xgb_step=0.3,        # first boosted member's learning rate
    lgb_step=0.1,        # second boosted member's learning rate
    lgb_subsample=0.8,   # rows drawn per round of the second boosted member
    lgb_min_rows=20,     # its least rows per leaf
)

# Rows of a training partition: boosting runs a job per tree level, so a small
# table in many partitions spends its time starting tasks.
# A partition has at least so many rows, and there are at most so many partitions
# a core: beyond that partitions grow with the table, not the number of tasks in
# each of the hundreds of boosting jobs.
ROWS_PER_FIT_PARTITION, FIT_PARTITIONS_PER_CORE = 20_000, 3


def fit_partitions(rows: int, cores: int) -> int:
    return max(1, min(-(-rows // ROWS_PER_FIT_PARTITION), FIT_PARTITIONS_PER_CORE * cores))


def _members(n: int, p: dict) -> list:
    # The usual L2 penalty with C = 1 on a weighted sum of losses equals
    # Spark's mean-loss objective with regParam = 1 / (sum of weights); the
    # balanced weights sum to n.  Neither regularises the intercept.
    lr = LogisticRegression(featuresCol=VECTOR, labelCol="_label", weightCol="_w_balanced",
                            maxIter=p["lr_max_iter"], regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                            standardization=False, probabilityCol="_p_lr", rawPredictionCol="_raw_lr",
                            predictionCol="_pred_lr")
    xgb = GBTClassifier(featuresCol=VECTOR, labelCol="_label", weightCol="_w_pos", maxIter=p["rounds"],
                        maxDepth=p["depth"], stepSize=p["xgb_step"], seed=p["seed"])
    lgb = GBTClassifier(featuresCol=VECTOR, labelCol="_label", weightCol="_w_pos", maxIter=p["rounds"],
                        maxDepth=p["depth"], stepSize=p["lgb_step"], subsamplingRate=p["lgb_subsample"],
                        minInstancesPerNode=p["lgb_min_rows"], seed=p["seed"] + 1)
    for name, m in (("xgb", xgb), ("lgb", lgb)):
        m.setProbabilityCol(f"_p_{name}").setRawPredictionCol(f"_raw_{name}").setPredictionCol(f"_pred_{name}")
    return [lr, xgb, lgb]


def training_frame(df: DataFrame, label_col: str, n0: int, n1: int) -> DataFrame:
    """Label as double plus the two weight columns: balanced (n / 2 n_c)
    for the logistic member, n0/n1 on positives for the boosted members."""
    if n1 == 0 or n0 == 0:
        raise ValueError("training data needs both classes")
    n = n0 + n1
    y = F.col(label_col)
    return df.select("*", y.cast("double").alias("_label"),
                     F.when(y == 1, F.lit(n / (2.0 * n1))).otherwise(F.lit(n / (2.0 * n0))).alias("_w_balanced"),
                     F.when(y == 1, F.lit(n0 / n1)).otherwise(F.lit(1.0)).alias("_w_pos"))


def fit_ensemble(train: DataFrame, features: list[str], label_col: str, **params) -> PipelineModel:
    """L2-L4 + L7 fit: one pipeline model (assembler + three members).

    The vectors are assembled and kept once, in partitions sized by the rows;
    the members only read them.  The boosted members are grown together in one
    barrier stage, after the logistic one: it needs all its tasks at once.
    """
    p = {**DEFAULTS, **params}
    require_columns(train, [*features, label_col])
    require_numeric(train, features)
    n0, n1 = class_counts(train, label_col)
    t = training_frame(train, label_col, n0, n1)
    asm = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error")
    ready = asm.transform(t).select(VECTOR, "_label", "_w_balanced", "_w_pos")
    cores = train.sparkSession.sparkContext.defaultParallelism
    ready = ready.repartition(fit_partitions(n0 + n1, cores)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lr, *boosted = _members(n0 + n1, p)
        return PipelineModel([asm, lr.fit(ready), *fit_boosted(ready, boosted, len(features), n0 / n1)])
    finally:
        ready.unpersist()


def model_features(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def member_probabilities(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` plus ``score_lr``, ``score_xgb``, ``score_lgb``: each member's P(1)."""
    require_columns(df, model_features(model))
    out = model.transform(df)
    keep = [c for c in df.columns]
    return out.select(*keep, *[vector_to_array(F.col(f"_p_{m}"))[1].alias(f"score_{m}") for m in MEMBERS])


def score(model: PipelineModel, df: DataFrame, digits: int | None = None) -> DataFrame:
    """L7 + L8: ``fraud_probability`` (soft vote) and ``fraud_prediction``."""
    s = member_probabilities(model, df)
    s = s.withColumn("fraud_probability", soft_vote([f"score_{m}" for m in MEMBERS], digits))
    return s.withColumn("fraud_prediction", vote_class("fraud_probability"))


def save_model(model: PipelineModel, path: str) -> str:
    """K6: write the model; an existing path is an error (versions are immutable)."""
    model.write().save(path)
    return path


def versioned_path(root: str, name: str, version: str) -> str:
    """K6 layout: ``{root}/models/{name}/{version}``."""
    return os.path.join(root, "models", name, version)


def load_model(path: str) -> PipelineModel:
    """S10."""
    return PipelineModel.load(path)


def split_counts(spark, stage_path: str, features: list[str]) -> DataFrame:
    """L5 (split-count importance): internal nodes per feature over all
    trees, read from the saved tree-ensemble stage with Spark — a grouped
    count over the node table, however many trees there are."""
    nodes = spark.read.parquet(os.path.join(stage_path, "data"))
    counts = (nodes.where(F.col("nodeData.split.featureIndex") >= 0)
                   .groupBy(F.col("nodeData.split.featureIndex").alias("idx"))
                   .agg(F.count(F.lit(1)).cast("double").alias("value")))
    names = spark.createDataFrame(list(enumerate(features)), "idx int, feature string")
    return names.join(counts, "idx", "left").select("feature", F.coalesce("value", F.lit(0.0)).alias("value"))


def member_importances(spark, model: PipelineModel, model_path: str) -> dict[str, DataFrame]:
    """|coefficients| of the logistic member, gain importance of the
    first boosted member, split counts of the second (from its saved data)."""
    feats = model_features(model)
    lr, xgb, lgb = model.stages[1], model.stages[2], model.stages[3]
    # PipelineModel writes stage i under "stages/{i}_{uid}".
    lgb_dir = os.path.join(model_path, "stages", f"3_{lgb.uid}")
    return {
        "lr": imp.model_importances(spark, feats, [abs(v) for v in lr.coefficients.toArray()]),
        "xgb": imp.model_importances(spark, feats, xgb.featureImportances.toArray()),
        "lgb": split_counts(spark, lgb_dir, feats),
    }


def train_with_selection(spark, train: DataFrame, features: list[str], label_col: str,
                         threshold: float = 0.05, run_id: str = "run", **params):
    """Fit on all features, rank the members' importances, keep those
    above ``threshold``, refit on the kept features.

    Returns (final model, ranked importance DataFrame, kept feature list in
    the order of importance).  Each fit keeps its own assembled vectors; the
    caller keeps ``train`` if it is dear to compute.
    """
    first = fit_ensemble(train, features, label_col, **params)
    path = scratch_path(spark, "models", "selection", run_id)
    first.write().overwrite().save(path)
    ranked = imp.rank_importances(member_importances(spark, first, path), digits=None)
    # One row per feature column: bounded by the schema.
    kept = [r["feature"] for r in imp.select_important(ranked, threshold).select("feature").collect()]
    if not kept:
        raise ValueError(f"no feature has mean importance above {threshold}")
    return fit_ensemble(train, kept, label_col, **params), ranked, kept

"""End-to-end training job — clean, split, fit with selection,
evaluate, save — as one driver function over DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..operators import metrics, models, prep, quality
from ..sinks import writers


def run_training(spark: SparkSession, source: DataFrame, out_root: str,
                 model_name: str = "fraud_detection_ensemble", version: str | None = None,
                 label_col: str = "fraud_flag", id_col: str = "booking_id", test_size: float = 0.3,
                 seed: int = 42, importance_threshold: float = 0.05, **params) -> dict:
    """Stages of the reference's training pipeline, in order:

    1. drop rows with NULLs; features = every column but label and id;
    2. exact stratified split (persisted: the profile, four fits and the
       evaluation read it);
    3. fit the ensemble on all features, rank importances, keep those above
       the threshold, refit;
    4. score the test split, evaluate, write the JSON report, the ranked
       importances, the full and the kept feature list (CSV, by importance),
       the train and test tables and one performance-log row; save the model
       under ``{out_root}/models/{name}/{version}``.
    """
    version = version or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    clean = quality.drop_null_rows(source)
    feats = prep.feature_columns(clean, label_col, id_col)
    split = prep.stratified_split(clean, label_col, id_col, test_size, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        profile = prep.dataset_profile(split, len(feats), label_col)
        train = split.where(F.col("split") == "train").drop("split")
        test = split.where(F.col("split") == "test").drop("split")
        model, ranked, kept = models.train_with_selection(spark, train, feats, label_col,
                                                          importance_threshold, run_id=f"{model_name}_{version}",
                                                          **params)
        model_path = models.save_model(model, models.versioned_path(out_root, model_name, version))
        scored = models.score(model, test)
        m = metrics.evaluation_metrics(scored, label_col, "fraud_probability").persist()
        report = metrics.evaluation_report(m, f"{model_name}_{version}")
        writers.write_report_json(report, f"{out_root}/evaluations/{model_name}_{version}_evaluation")
        run = f"{model_name}_{version}"
        writers.write_csv(spark.createDataFrame([(f,) for f in kept], "features string").coalesce(1),
                          f"{out_root}/features/{run}")
        writers.write_csv(spark.createDataFrame([(f,) for f in feats], "features string").coalesce(1),
                          f"{out_root}/all_features/{run}")
        ranked.coalesce(1).write.parquet(f"{out_root}/importances/{run}")
        split.write.partitionBy("split").parquet(f"{out_root}/datasets/{run}")
        writers.log_performance(m, f"{out_root}/model_performance", model_name, version)
        n0, n1 = prep.class_counts(train, label_col)
        mrow = m.collect()[0].asDict()   # one row of figures
        training_metrics = {"roc_auc": mrow["roc_auc"], "pr_auc": mrow["pr_auc"],
                            "n_selected_features": len(kept), "scale_pos_weight": n0 / n1}
        return {"model": model, "model_path": model_path, "features": kept, "importance": ranked,
                "profile": profile.collect()[0].asDict(), "metrics": mrow,
                "training_metrics": training_metrics}
    finally:
        split.unpersist()


def evaluate_saved(spark: SparkSession, model_path: str, dataset: str, label_col: str = "fraud_flag") -> DataFrame:
    """Evaluation of a saved model on the test part of a saved data set
    (``{out_root}/datasets/{name}_{version}``): one row of figures."""
    test = spark.read.parquet(dataset).where(F.col("split") == "test").drop("split")
    return metrics.evaluation_metrics(models.score(models.load_model(model_path), test), label_col, "fraud_probability")


def main(argv=None) -> dict:
    """Command line: train on a Parquet folder or a catalog table."""
    import argparse
    import json

    ap = argparse.ArgumentParser(description="train the risk ensemble")
    ap.add_argument("--input", required=True, help="Parquet path or catalog table name")
    ap.add_argument("--out", required=True, help="shared output root (models, reports, logs)")
    ap.add_argument("--model-name", default="fraud_detection_ensemble")
    ap.add_argument("--version")
    ap.add_argument("--test-size", type=float, default=0.3)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--importance-threshold", type=float, default=0.05)
    ap.add_argument("--rounds", type=int, default=100)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    src = spark.read.parquet(a.input) if "/" in a.input else spark.table(a.input)
    out = run_training(spark, src, a.out, a.model_name, a.version, test_size=a.test_size, seed=a.seed,
                       importance_threshold=a.importance_threshold, rounds=a.rounds)
    summary = {k: out[k] for k in ("model_path", "features", "profile", "metrics", "training_metrics")}
    print(json.dumps(summary, indent=2, default=str))
    return summary


if __name__ == "__main__":
    main()

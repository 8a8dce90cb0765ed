import os

from pyspark.sql import functions as F

from riskloom.operators import models, prep
from riskloom.plans import queries as Q
from riskloom.plans.batch_job import run_batch_prediction
from riskloom.plans.health_job import health_json
from riskloom.plans.training_job import evaluate_saved, run_training
from riskloom.streaming import monitors, scoring as sscoring

SF = "/root/testdata/sf0.001"


def test_training_job_save_load_batch_and_stream(spark, tmp_dir):
    b = Q.booking_df(spark, SF)
    out = run_training(spark, b, tmp_dir, version="t1", rounds=3, lr_max_iter=50)
    assert out["features"] and set(out["features"]) <= set(prep.feature_columns(b))
    m = out["metrics"]
    assert m["true_negatives"] + m["false_positives"] + m["false_negatives"] + m["true_positives"] == \
        out["profile"]["test_samples"]
    assert 0.0 <= m["roc_auc"] <= 1.0
    assert os.path.isdir(os.path.join(tmp_dir, "models", "fraud_detection_ensemble", "t1"))
    assert spark.read.parquet(os.path.join(tmp_dir, "model_performance")).count() == 1
    ranked = out["importance"].collect()
    assert abs(sum(r["lr"] for r in ranked) - 1.0) < 1e-6 and abs(sum(r["lgb"] for r in ranked) - 1.0) < 1e-6

    # what the job wrote is enough to evaluate the saved model again
    again = evaluate_saved(spark, out["model_path"], os.path.join(tmp_dir, "datasets", "fraud_detection_ensemble_t1")).first()
    assert again["roc_auc"] == m["roc_auc"] and again["true_positives"] == m["true_positives"]
    by_rank = [r["feature"] for r in ranked if r["feature"] in set(out["features"])]
    assert out["features"] == by_rank == models.model_features(out["model"])
    kept = spark.read.option("header", True).csv(os.path.join(tmp_dir, "features", "fraud_detection_ensemble_t1"))
    assert [r["features"] for r in kept.collect()] == by_rank

    # batch prediction with the saved model, summary from the written table
    summ = run_batch_prediction(spark, b, out["model_path"], os.path.join(tmp_dir, "pred"),
                                scored_at=F.lit("2024-02-01 00:00:00"), csv_path=os.path.join(tmp_dir, "pred_csv")).first()
    csv_cols = spark.read.option("header", True).csv(os.path.join(tmp_dir, "pred_csv")).columns
    assert csv_cols == ["booking_id", "fraud_probability", "fraud_prediction", "prediction_timestamp", "risk_category"]
    assert summ["total_predictions"] == b.count()
    assert summ["n_low"] + summ["n_medium"] + summ["n_high"] == b.count()

    # streaming scoring with the loaded model equals batch scoring
    model = models.load_model(out["model_path"])
    src_dir = os.path.join(tmp_dir, "stream_in")
    b.write.parquet(src_dir)
    stream = sscoring.read_stream(spark, src_dir, spark.read.parquet(src_dir).schema)
    pred = sscoring.stream_predictions(stream, model=model, scored_at=F.lit("2024-02-01 00:00:00"))
    q = sscoring.start_parquet_sink(pred, os.path.join(tmp_dir, "stream_out"), os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    streamed = spark.read.parquet(os.path.join(tmp_dir, "stream_out"))
    batch = spark.read.parquet(os.path.join(tmp_dir, "pred"))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_empty_batch_prediction_writes_schema(spark, tmp_dir):
    b = Q.booking_df(spark, SF)
    out = run_training(spark, b, tmp_dir, version="t2", rounds=2, lr_max_iter=20)
    summ = run_batch_prediction(spark, b.limit(0), out["model_path"], os.path.join(tmp_dir, "p0")).first()
    assert summ["total_predictions"] == 0
    assert spark.read.parquet(os.path.join(tmp_dir, "p0")).columns[0] == "booking_id"


def test_stream_monitor_equals_batch(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    src = sscoring.read_stream(spark, SF, ev.schema, glob="events.parquet")
    q = monitors.start_monitor_sink(monitors.windowed_monitor(src), os.path.join(tmp_dir, "m"),
                                    os.path.join(tmp_dir, "mck"))
    q.awaitTermination()
    got = {r["window_start"].date(): r["n_events"] for r in monitors.read_monitor(spark, os.path.join(tmp_dir, "m")).collect()}
    daily = {r["d"]: r["n"] for r in ev.groupBy(F.to_date("ts").alias("d")).agg(F.count("*").alias("n")).collect()}
    assert got == daily  # the running day included


def test_health_json(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    doc = health_json(e, "events", "ts", "2024-01-31")
    assert '"freshness_status"' in doc and '"quality_score"' in doc


def test_stream_monitor_drops_rows_behind_the_watermark(spark, tmp_dir):
    """Two micro-batches: the second brings rows for a day whose window the
    first batch's watermark already closed; they are ignored."""
    import datetime as dt
    src = os.path.join(tmp_dir, "late_src")
    os.makedirs(src)
    schema = "event_id long, ts timestamp_ntz, event_type string"
    day = dt.datetime(2024, 1, 1)
    first = [(i, day + dt.timedelta(hours=i), "view" if i % 4 else "error") for i in range(60)]   # up to Jan 3 11:00
    late = [(100 + i, day + dt.timedelta(hours=2), "error") for i in range(5)]                    # Jan 1: closed
    fresh = [(200, day + dt.timedelta(days=3, hours=5), "view")]                                   # Jan 4
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(os.path.join(src, "b1"))
    stream = sscoring.read_stream(spark, os.path.join(src, "*"), spark.createDataFrame([], schema).schema,
                                  max_files_per_trigger=1)
    out, ck = os.path.join(tmp_dir, "late_out"), os.path.join(tmp_dir, "late_ck")
    q = monitors.start_monitor_sink(monitors.windowed_monitor(stream), out, ck)
    q.awaitTermination()
    spark.createDataFrame(late + fresh, schema).coalesce(1).write.parquet(os.path.join(src, "b2"))
    q = monitors.start_monitor_sink(monitors.windowed_monitor(stream), out, ck)
    q.awaitTermination()
    got = {r["window_start"].date(): (r["n_events"], r["n_errors"]) for r in monitors.read_monitor(spark, out).collect()}
    assert got[dt.date(2024, 1, 1)] == (24, 6)          # late rows not counted
    assert got[dt.date(2024, 1, 2)] == (24, 6)
    assert got[dt.date(2024, 1, 3)] == (12, 3)          # as the first batch left it
    assert got[dt.date(2024, 1, 4)] == (1, 0)           # still open


def test_logistic_member_reaches_penalised_optimum(spark):
    """The logistic member minimises 0.5*||beta||^2 + sum_i w_i * logloss_i
    (L2, C = 1, balanced weights, unscaled features): the gradient of that
    objective at Spark's solution vanishes (checked per standardised unit)."""
    import numpy as np
    train = Q.split_df(spark, SF).where("split='train'").drop("split")
    feats = prep.feature_columns(Q.booking_df(spark, SF))
    lr = models.fit_ensemble(train, feats, "fraud_flag", rounds=2).stages[1]
    pdf = train.select(*feats, "fraud_flag").toPandas()   # sf0.001 fixture: ~1k rows
    X, y = pdf[feats].to_numpy(float), pdf["fraud_flag"].to_numpy(float)
    n, n1 = len(y), y.sum()
    w = np.where(y == 1, n / (2 * n1), n / (2 * (n - n1)))
    beta = lr.coefficients.toArray()
    p = 1 / (1 + np.exp(-(X @ beta + lr.intercept)))
    grad = beta + X.T @ (w * (p - y))
    assert np.max(np.abs(grad) / X.std(axis=0)) / n < 1e-4
    assert abs(np.sum(w * (p - y))) / n < 1e-4


def test_command_lines(spark, tmp_dir, capsys):
    import json as _json

    from riskloom.plans import batch_job, health_job, training_job
    doc = _json.loads(health_job.main(["--table", f"{SF}/events.parquet", "--operation", "freshness",
                                        "--ts-column", "ts", "--as-of", "2024-01-31"]))
    assert doc["freshness"]["freshness_status"] == "Recent"
    doc = _json.loads(health_job.main(["--table", f"{SF}/orders.parquet", "--operation", "stats"]))
    assert doc["stats"]["row_count"] == doc["rows"]["total_rows"]
    src = os.path.join(tmp_dir, "booking")
    Q.booking_df(spark, SF).write.parquet(src)
    out = training_job.main(["--input", src, "--out", tmp_dir, "--version", "cli", "--rounds", "2"])
    assert out["training_metrics"]["n_selected_features"] == len(out["features"])
    summ = batch_job.main(["--input", src, "--model", out["model_path"], "--output", os.path.join(tmp_dir, "p")])
    assert summ["total_predictions"] == spark.read.parquet(src).count()
    capsys.readouterr()


def test_score_instances(spark, tmp_dir):
    import json as _json

    import pytest as _pytest

    from riskloom.plans.batch_job import score_instances
    b = Q.booking_df(spark, SF)
    out = run_training(spark, b, tmp_dir, version="inst", rounds=2, lr_max_iter=20)
    feats = out["features"]
    rows = [r.asDict() for r in b.select(*feats).limit(3).collect()]   # request-sized document
    p = os.path.join(tmp_dir, "req.json")
    with open(p, "w") as fh:
        _json.dump({"instances": rows}, fh)
    got = score_instances(spark, p, out["model_path"]).collect()
    assert len(got) == 3 and all(r["risk_category"] in ("LOW", "MEDIUM", "HIGH") for r in got)
    bad = os.path.join(tmp_dir, "bad.json")
    with open(bad, "w") as fh:
        _json.dump({"instances": [{"qty_sum": 1.0}]}, fh)
    with _pytest.raises(ValueError, match="Missing features"):
        score_instances(spark, bad, out["model_path"])

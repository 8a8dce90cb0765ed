from pyspark.sql import functions as F

from riskloom.operators import scoring


def test_risk_tiers_and_vote_at_boundaries(spark):
    df = spark.createDataFrame([("a", 0.2999999), ("b", 0.3), ("c", 0.5), ("d", 0.5000001), ("e", 0.7), ("f", None)],
                               "id string, p double")
    out = {r["booking_id"]: r for r in scoring.prediction_rows(df, "id", F.col("p"), "2024-02-01 00:00:00").collect()}
    assert out["a"]["risk_category"] == "LOW" and out["b"]["risk_category"] == "MEDIUM"
    assert out["e"]["risk_category"] == "HIGH" and out["f"]["risk_category"] is None
    assert out["c"]["fraud_prediction"] == 0 and out["d"]["fraud_prediction"] == 1


def test_prediction_schema(spark):
    df = spark.createDataFrame([(1, 0.4)], "id long, p double")
    out = scoring.prediction_rows(df, "id", F.col("p"), "2024-02-01 00:00:00")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in scoring.PREDICTION_SCHEMA]


def test_soft_vote_mean(spark):
    df = spark.createDataFrame([(0.2, 0.5, 0.8)], "a double, b double, c double")
    r = df.select(scoring.soft_vote(["a", "b", "c"], 6).alias("p")).first()
    assert r["p"] == 0.5


def test_summary_and_empty_input(spark):
    empty = spark.createDataFrame([], scoring.PREDICTION_SCHEMA)
    r = scoring.prediction_summary(empty).first()
    assert r["total_predictions"] == 0 and r["fraud_predictions"] == 0 and r["avg_fraud_probability"] is None


def test_iso_timestamp_matches_isoformat(spark):
    import datetime as dt

    from riskloom.functions.scalar import iso_timestamp, run_id
    vals = [dt.datetime(2024, 2, 1, 0, 0, 0), dt.datetime(2024, 2, 1, 13, 5, 9, 120000)]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    got = [r[0] for r in df.select(iso_timestamp("t")).collect()]
    assert got == [v.isoformat() for v in vals]
    assert df.select(run_id("t")).first()[0] == "20240201_000000"


def test_a_missing_score_has_no_class(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.2), ("c", 0.9)], "id string, p double")
    rows = scoring.prediction_rows(df, "id", F.col("p"), "2024-01-01 00:00:00").collect()
    assert [(r.fraud_prediction, r.risk_category) for r in rows] == [(None, None), (0, "LOW"), (1, "HIGH")]

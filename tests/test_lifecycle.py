"""Kept tables, states, sketches, checked input and streams without repeats: what
must hold beyond the registered queries."""

import datetime as dt
import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from riskloom.functions.scalar import risk_tier
from riskloom.operators import metrics, monitoring, multiclass, quality, scoring, sketches, table_state
from riskloom.plans import lifecycle as L
from riskloom.sinks import versioned, writers
from riskloom.sources import files, partitioned
from riskloom.sources.tables import execute_query
from riskloom.streaming import labels, monitors, once, scoring as stream_scoring

SF = "/root/testdata/sf0.001"
NAN = float("nan")


def failing(df):
    """The frame with a row that fails while it is written."""
    return df.withColumn("booking_id", F.when(F.col("booking_id") == "7", F.raise_error(F.lit("lost half-way")))
                         .otherwise(F.col("booking_id")))


@pytest.fixture
def pred(spark):
    rows = spark.range(40).select(F.col("id").cast("string").alias("booking_id"), (F.col("id") / 40).alias("p"))
    return scoring.prediction_rows(rows, "booking_id", F.col("p"), "2024-02-01 00:00:00")


# ------------------------------------------------------------------ K1

def test_a_load_that_fails_half_way_leaves_the_table(spark, tmp_dir, pred):
    path = os.path.join(tmp_dir, "pred")
    assert writers.replace_predictions(pred, path) == 1
    with pytest.raises(Exception, match="lost half-way"):
        writers.replace_predictions(failing(pred).repartition(4), path)
    with pytest.raises(versioned.LoadRejected):
        writers.replace_predictions(pred.limit(3), path, min_rows=10)
    assert versioned.read_table_version(spark, path).count() == 40
    assert versioned.manifest(spark, path)["version"] == 1
    assert len(versioned.remove_leftovers(spark, path, 2**60)) == 1  # the rejected rows; Spark removes what failed
    assert versioned.read_table_version(spark, path).count() == 40


def test_readers_of_an_older_version_finish(spark, tmp_dir, pred):
    path = os.path.join(tmp_dir, "pred")
    writers.replace_predictions(pred, path)
    old = versioned.read_table_version(spark, path)
    assert writers.replace_predictions(pred.limit(5), path) == 2
    assert old.count() == 40 and versioned.read_table_version(spark, path).count() == 5
    assert versioned.read_table_version(spark, path, 1).count() == 40
    writers.replace_predictions(pred.limit(0), path)
    assert versioned.read_table_version(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        versioned.read_table_version(spark, path, 1)
    assert len(glob.glob(f"{path}/data/*")) == 2


def test_of_two_loads_that_race_one_fails(spark, tmp_dir, pred, monkeypatch):
    path = os.path.join(tmp_dir, "pred")
    writers.replace_predictions(pred, path)
    real = versioned.write_checked

    def slow(df, folder, check=None):
        n = real(df, folder, check)
        monkeypatch.setattr(versioned, "write_checked", real)
        versioned.replace_table(df.limit(1), path)  # the other load is done first
        return n

    monkeypatch.setattr(versioned, "write_checked", slow)
    with pytest.raises(versioned.LoadRejected, match="another load"):
        versioned.replace_table(pred, path)
    assert versioned.read_table_version(spark, path).count() == 1


def test_plain_folder_and_catalog_table_survive_a_failed_load(spark, tmp_dir, pred):
    path = os.path.join(tmp_dir, "plain")
    writers.write_predictions(pred, path)
    with pytest.raises(Exception, match="lost half-way"):
        writers.write_predictions(failing(pred), path)
    assert spark.read.parquet(path).count() == 40
    writers.write_predictions(pred.limit(2), path)
    assert spark.read.parquet(path).count() == 2
    writers.save_predictions_table(pred, "kept_predictions")
    with pytest.raises(Exception, match="lost half-way"):
        writers.save_predictions_table(failing(pred), "kept_predictions")
    assert spark.table("kept_predictions").count() == 40


# ----------------------------------------------------------- S2, P5, P7

@pytest.fixture
def by_date(spark, tmp_dir):
    path = os.path.join(tmp_dir, "events")
    partitioned.write_dates(spark.read.parquet(f"{SF}/events.parquet"), path, "ts")
    return path


def spoil(path, but=()):
    """Makes the files of all partitions but some unreadable."""
    for f in glob.glob(f"{path}/*/*.parquet"):
        if not any(d in f for d in but):
            with open(f, "wb") as out:
                out.write(b"no parquet")
            crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
            if os.path.exists(crc):
                os.replace(crc, crc + "-old")


def test_only_the_wanted_days_are_read(spark, by_date):
    e = spark.read.parquet(f"{SF}/events.parquet")
    schema = spark.read.parquet(by_date).schema
    spoil(by_date, ["2024-01-10", "2024-01-11"])
    out = partitioned.partition_extract(spark, by_date, "2024-01-10", "2024-01-11", tie_col="event_id", schema=schema)
    assert out.count() == e.where("to_date(ts) between '2024-01-10' and '2024-01-11'").count() > 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_days_named_by_a_table_prune_the_scan(spark, by_date, tmp_dir):
    days = os.path.join(tmp_dir, "days")
    spark.createDataFrame([(dt.date(2024, 1, 12), "x"), (dt.date(2024, 1, 20), "y")], "day date, why string").write.parquet(days)
    out = partitioned.rows_of_dates(spark, by_date, spark.read.parquet(days).where("why = 'x'").select("day"))
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
    assert {r[0] for r in out.select("ingest_date").distinct().collect()} == {dt.date(2024, 1, 12)}


def test_late_rows_rewrite_their_days_only(spark, by_date):
    e = spark.read.parquet(f"{SF}/events.parquet")
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{by_date}/*/*.parquet")}
    late = e.where("to_date(ts) = '2024-01-15'").withColumn("value", F.lit(-1.0))
    late = late.unionByName(e.limit(1).withColumn("ts", F.lit("2024-03-01 10:00:00").cast("timestamp_ntz")))
    days = partitioned.merge_late(spark, by_date, late, "event_id", "ts")
    assert days == [dt.date(2024, 1, 15), dt.date(2024, 3, 1)]
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{by_date}/*/*.parquet")}
    assert {f: t for f, t in before.items() if "2024-01-15" not in f} == {
        f: t for f, t in after.items() if "2024-01-15" not in f and "2024-03-01" not in f}
    got = spark.read.parquet(by_date)
    assert got.count() == e.count() + 1
    assert got.where("ingest_date = '2024-01-15' and value <> -1").count() == 0


# ----------------------------------------------------------------- A8-A13

def test_only_changed_partitions_are_scanned_again(spark, by_date, tmp_dir):
    states = os.path.join(tmp_dir, "states")
    table_state.write_states(table_state.partition_states(spark.read.parquet(by_date)), states)
    want = {r.column_name: r for r in table_state.merge_states(spark.read.parquet(states)).collect()}
    schema = spark.read.parquet(by_date).schema
    spoil(by_date, ["2024-01-05"])
    table_state.refresh_states(spark, by_date, states, [dt.date(2024, 1, 5), dt.date(2030, 1, 1)], schema=schema)
    merged = table_state.merge_states(spark.read.parquet(states))
    assert {r.column_name: r for r in merged.collect()} == want
    profile = quality.column_profile(spark.read.parquet(f"{SF}/events.parquet"))
    assert merged.select(profile.columns).exceptAll(profile).count() == 0


def test_merged_deviation_keeps_its_digits(spark):
    rows = [(dt.date(2024, 1, 1 + k % 3), 1e9 + k % 7, [None, "", "x"][k % 3]) for k in range(60)] + [
        (dt.date(2024, 1, 1), NAN, "y"), (None, None, None)]
    df = spark.createDataFrame(rows, "ingest_date date, x double, s string")
    got = {r.column_name: r for r in table_state.merge_states(table_state.partition_states(df)).collect()}
    values = [r[1] for r in rows if r[1] is not None and not math.isnan(r[1])]
    mean = sum(values) / len(values)
    assert got["x"].n_values == 60 and got["x"].nulls == 1 and got["x"].mean == pytest.approx(mean, abs=1e-4)
    assert got["x"].stddev == pytest.approx((sum((v - mean) ** 2 for v in values) / 59) ** 0.5, abs=1e-5)
    assert got["s"].empties == 41 and got["s"].nulls == 21 and got["s"].mean is None
    empty = table_state.partition_states(df.limit(0))
    assert table_state.quality_of_states(empty).first().assessment == "No Data"
    assert table_state.freshness_of_states(empty, "2024-01-31").first().freshness_status == "No Data"


# --------------------------------------------------------------- sketches

def test_sketches_leave_missing_values_out(spark):
    df = spark.createDataFrame([("a", float(k), k % 4) for k in range(1000)] + [("a", NAN, 0), ("a", None, 1), (None, 5.0, 1)],
                               "g string, v double, period int")
    sk = sketches.quantile_sketches(df, "v", F.col("period"), ["g"])
    merged = sketches.merged_quantiles(sk, ["g"])
    errors = sketches.measured_rank_errors(df, "v", merged, ["g"])
    got = {r.g: r for r in errors.collect()}
    assert got["a"].n == 1000 and got[None].n == 1
    assert all(e <= 2 * sketches.rank_error_bound() for r in got.values() for e in (r.e50, r.e95, r.e99))
    assert sketches.merged_quantiles(sketches.quantile_sketches(df.limit(0), "v", F.col("period"), ["g"]), ["g"]).count() == 0


def test_row_sketches_merge_over_partitions(spark):
    df = spark.createDataFrame([(k % 5000, None if k % 2 else "x") for k in range(20_000)], "a long, b string")
    profile = sketches.sketched_row_profile(sketches.row_sketches(df, F.col("a") % 9)).first()
    exact = quality.row_profile(df).first()
    assert profile.total_rows == exact.total_rows == 20_000
    assert abs(profile.unique_rows - exact.unique_rows) <= sketches.distinct_error_bound() * exact.unique_rows
    assert tuple(sketches.sketched_row_profile(sketches.row_sketches(df.limit(0))).first()) == (0, 0, 0)


# ------------------------------------------------------------ S7, S3, A18

def test_every_line_is_accepted_or_rejected(spark, tmp_dir):
    lines = ['{"a": 1, "b": "x"}', '{"a": "one", "b": "y"}', '{"a": 2', 'text', '{"b": "z"}', '[]', '{"a": 3, "c": 1}',
             '[{"a": 4}, {"a": 5}]', 'null']
    path = os.path.join(tmp_dir, "in.jsonl")
    with open(path, "w") as f:
        f.write("\n \n".join(lines) + "\n")
    with pytest.raises(files.TooManyRejected, match="6 of 9 lines|5 of 9 lines"):
        files.read_jsonl_checked(spark, path, "a long, b string", 0.1)
    accepted, rejected, counts = files.read_jsonl_checked(spark, path, "a long, b string", 0.9)
    assert counts["read"] == len(lines) == accepted.count() + rejected.count()
    assert {r.line for r in rejected.collect()} == {'{"a": "one", "b": "y"}', '{"a": 2', "text", "[]", '[{"a": 4}, {"a": 5}]', "null"}
    assert {(r.a, r.b) for r in accepted.collect()} == {(1, "x"), (None, "z"), (3, None)}
    assert all(r.file.endswith("in.jsonl") for r in rejected.collect())


def test_bound_values_are_values(spark):
    spark.createDataFrame([("it's", 1), ('a"b', 2), ("c", 3)], "s string, n int").createOrReplaceTempView("quoted")
    q = "SELECT n FROM IDENTIFIER(:t) WHERE s = :s"
    assert [r.n for r in execute_query(spark, q, {"t": "quoted", "s": "it's"}).collect()] == [1]
    assert execute_query(spark, q, {"t": "quoted", "s": "' OR '1' = '1"}).count() == 0
    with pytest.raises(Exception):
        execute_query(spark, q, {"t": "quoted; DROP TABLE quoted", "s": "c"})


def test_report_of_classes_that_are_never_right(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a"), (None, "a"), ("b", None)], "y string, p string")
    got = {r.class_label: r for r in multiclass.multiclass_report(df, "y", "p").collect()}
    assert got["b"].precision == 0 and got["b"].support == 0 and got["c"].recall == 0 and got["c"].support == 1
    assert got["accuracy"].f1_score == pytest.approx(1 / 3, abs=1e-6) and got["macro avg"].support == 3
    assert multiclass.multiclass_report(df.limit(0), "y", "p").where("class_label = 'accuracy' and f1_score is null").count() == 1


# --------------------------------------------------------------------- NaN

def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(1, 0.9, "b"), (0, 0.2, "b"), (0, NAN, "b"), (1, None, "c"), (0, 0.4, "c")],
                               "y int, s double, period string")
    tiers = df.select(risk_tier("s").alias("t"), scoring.vote_class("s").alias("c"),
                      scoring.soft_vote([F.col("s"), F.lit(0.5)]).alias("v")).collect()
    assert [tuple(r)[:2] for r in tiers] == [("HIGH", 1), ("LOW", 0), (None, None), (None, None), ("MEDIUM", 0)]
    assert tiers[2].v is None
    m = metrics.evaluation_metrics(df, "y", "s").first()
    assert m.roc_auc == 1.0 and m.false_positives == 0 and m.true_negatives == 2
    p = monitoring.exact_percentiles(df, "s").first()
    assert p.n == 3 and p.p50 == 0.4
    bins = monitoring.psi(df, "s", "period", "b", "c").collect()
    assert {r.bin: r.n_baseline for r in bins if r.n_baseline} == {9: 1, 2: 1}


def test_input_of_nothing_but_nan(spark):
    df = spark.createDataFrame([(1, NAN, "b"), (0, NAN, "c")], "y int, s double, period string")
    m = metrics.evaluation_metrics(df, "y", "s").first()
    assert m.roc_auc is None and m.true_positives == m.false_positives == 0
    assert monitoring.exact_percentiles(df, "s", by=["period"]).count() == 0
    assert monitoring.psi(df, "s", "period", "b", "c").count() == 0
    assert metrics.roc_curve(df, "y", "s").count() == 0
    assert scoring.prediction_rows(df.withColumn("booking_id", F.lit("1")), "booking_id", F.col("s"),
                                   "2024-02-01 00:00:00").where("fraud_probability is null").count() == 2


# ----------------------------------------------------------------- streams

def test_a_label_past_the_bound_is_none(spark, tmp_dir):
    scores = spark.createDataFrame([(k, f"2024-01-0{k}", k % 2) for k in range(1, 6)], "k int, ts string, fraud_prediction int")
    scores = scores.withColumn("ts", F.col("ts").cast("timestamp"))
    known = scores.select("k", F.lit(1).alias("y"), F.expr("ts + make_dt_interval(k * 3)").alias("at")).where("k <> 3")
    for df, ts, name in ((scores, "ts", "s"), (known, "at", "l")):
        df.write.parquet(f"{tmp_dir}/{name}")
        labels.closing_row(df, ts, "2030-01-01").write.mode("append").parquet(f"{tmp_dir}/{name}")
    stream = [stream_scoring.read_stream(spark, f"{tmp_dir}/{n}", spark.read.parquet(f"{tmp_dir}/{n}").schema) for n in "sl"]
    out = labels.labelled_scores(*stream, "k", "ts", "at", "y", "10 DAYS")
    labels.start_labelled_sink(out, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    got = {r.k: r.y for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {1: 1, 2: 1, 3: None, 4: None, 5: None}


def test_a_restart_and_a_lost_checkpoint_leave_one_row_per_key(spark, tmp_dir):
    df = spark.range(50).select("id", F.expr("timestamp'2024-01-01' + make_dt_interval(0, cast(id as int))").alias("ts"))
    df.write.parquet(f"{tmp_dir}/in")

    def run(checkpoint):
        s = stream_scoring.read_stream(spark, f"{tmp_dir}/in", spark.read.parquet(f"{tmp_dir}/in").schema)
        once.start_keyed_sink(once.first_arrivals(s, "id", "ts", "10 days"), f"{tmp_dir}/out", checkpoint).awaitTermination()

    run(f"{tmp_dir}/ck")
    df.where("id < 20").write.mode("append").parquet(f"{tmp_dir}/in")  # a replayed file
    run(f"{tmp_dir}/ck")
    run(f"{tmp_dir}/ck2")  # the checkpoint is lost
    got = once.read_keyed(spark, f"{tmp_dir}/out", ["id"])
    assert got.count() == 50 and got.select("id").distinct().count() == 50


def test_compaction_changes_nothing_that_is_read(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    for batch in range(4):
        rows = [(k, k + 1, batch * 10 + k) for k in range(batch, batch + 3)]
        spark.createDataFrame(rows, "window_start int, window_end int, n int").write.parquet(f"{sink}/batch={batch}")
    want = {tuple(r) for r in monitors.read_monitor(spark, sink).collect()}
    assert monitors.compact_monitor(spark, sink) == 3
    assert not glob.glob(f"{sink}/batch=*")
    assert {tuple(r) for r in monitors.read_monitor(spark, sink).collect()} == want
    spark.createDataFrame([(0, 1, 99)], "window_start int, window_end int, n int").write.parquet(f"{sink}/batch=4")
    want = {(0, 1, 99)} | {r for r in want if r[0] != 0}
    assert {tuple(r) for r in monitors.read_monitor(spark, sink).collect()} == want
    assert monitors.compact_monitor(spark, sink) == 4 == monitors.compact_monitor(spark, sink)
    assert {tuple(r) for r in monitors.read_monitor(spark, sink).collect()} == want


def test_contributions_sum_to_the_raw_scores(spark, tmp_dir):
    from riskloom.operators import explain, models
    from riskloom.plans import queries as Q
    b = Q.booking_df(spark, SF)
    feats = ["qty_sum", "avg_discount", "n_items"]
    model = models.fit_ensemble(b, feats, "fraud_flag", rounds=4, depth=3, lr_max_iter=20)
    path = models.save_model(model, os.path.join(tmp_dir, "m"))
    got = explain.explanations(spark, model, path, b)
    sums = got.groupBy("booking_id", "member").agg(F.sum("contribution").alias("s"))
    both = explain.raw_scores(model, b).join(sums, ["booking_id", "member"])
    assert both.count() == 3 * b.count()
    assert both.where("abs(raw - s) > 1e-9 * (1 + abs(raw))").count() == 0
    assert {r[0] for r in got.select("feature").distinct().collect()} <= {*feats, explain.BASE}
    top = explain.top_reasons(got, 2)
    assert top.groupBy("booking_id", "member").count().where("count > 2").count() == 0
    assert "PythonUDF" not in got._jdf.queryExecution().executedPlan().toString()


def test_fit_partitions_follow_rows_then_cores():
    from riskloom.operators.models import fit_partitions
    assert [fit_partitions(n, 8) for n in (0, 1, 20_001, 10**6, 5 * 10**9)] == [1, 1, 2, 24, 24]


def test_queries_have_sql():
    from riskloom.plans.lifecycle_oracles import ORACLES
    assert set(L.QUERIES) == set(ORACLES)

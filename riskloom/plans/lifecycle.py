"""Registered queries over kept tables: atomic loads, tables by date, states and
sketches that merge, checked input, streams without repeats.

Like the others, each reads whole driver tables and takes (spark, sf_dir).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import explain, metrics, models, monitoring, multiclass, quality, scoring, sketches, table_state
from ..session import scratch_path
from ..sinks import versioned, writers
from ..sources import derived, files, metadata, partitioned
from ..sources.tables import execute_query, read_table, register_tables
from ..streaming import drift, labels, monitors, once
from ..streaming import scoring as stream_scoring
from . import queries as Q

REWRITTEN_DAY = "2024-01-10"
APPENDED_DAYS_LATER = 31
STREAM_END = "2100-01-01"
LABEL_WITHIN_DAYS = 90
DRIFT_WINDOW_DAYS, DRIFT_SLIDE_DAYS = 360, 180


def _folder(spark, label: str) -> str:
    return scratch_path(spark, label, uuid.uuid4().hex[:12])


# ------------------------------------------------------- missing as NaN

def _nan_where(df, column: str, condition: str):
    return df.withColumn(column, F.when(F.expr(condition), F.lit(float("nan"))).otherwise(F.col(column).cast("double")))


def q_score_table_nan(spark, sf_dir):
    """Scoring of rows with NaN features: no score, no class, no tier."""
    b = _nan_where(Q.booking_df(spark, sf_dir), "qty_sum", "n_items = 3")
    return scoring.prediction_rows(Q.scored_df(spark, sf_dir, b), "booking_id", F.col("fraud_probability"), Q.SCORED_AT)


def _scored_nan(spark, sf_dir):
    return _nan_where(Q.scored_df(spark, sf_dir), "fraud_probability", "n_items = 3")


def q_evaluation_metrics_nan(spark, sf_dir):
    return metrics.evaluation_metrics(_scored_nan(spark, sf_dir), "fraud_flag", "fraud_probability")


def q_percentiles_nan(spark, sf_dir):
    e = _nan_where(read_table(spark, sf_dir, "events"), "value", "event_id % 7 = 0")
    return monitoring.exact_percentiles(e, "value", by=["event_type"])


def q_psi_nan(spark, sf_dir):
    p = Q.timed_predictions(spark, sf_dir).withColumn("year", F.year("booking_ts"))
    p = _nan_where(p, "fraud_probability", "cast(booking_id as bigint) % 5 = 0")
    return monitoring.psi(p, "fraud_probability", "year", Q.PSI_BASELINE, Q.PSI_CURRENT)


# ------------------------------------------------------------- kept tables

def q_prediction_versions(spark, sf_dir):
    """K1: all predictions loaded, then replaced by those of the two upper
    tiers; the current table and the rows that the kept versions hold."""
    path, pred = _folder(spark, "tables"), Q.predictions_df(spark, sf_dir)
    writers.replace_predictions(pred, path)
    writers.replace_predictions(pred.where("risk_category <> 'LOW'"), path)
    versions = versioned.table_history(spark, path)
    current = versioned.read_table_version(spark, path).groupBy("risk_category").agg(F.count(F.lit(1)).alias("rows"))
    return versions.select(F.concat(F.lit("version "), F.col("version").cast("string")).alias("part"), "rows").unionByName(
        current.select(F.concat(F.lit("current "), F.col("risk_category")).alias("part"), "rows"))


def late_rows(events):
    """Rows that arrive late: those of one day again with other values, and
    every error once more a month later."""
    again = events.where(F.to_date("ts") == F.lit(REWRITTEN_DAY).cast("date")).select(
        "event_id", "ts", "user_id", F.when(F.col("event_type") != "view", F.col("event_type")).otherwise(F.lit("")).alias("event_type"),
        F.when(F.col("event_id") % 2 == 1, F.col("value")).alias("value"), "props")
    later = events.where("event_type = 'error'").withColumn("ts", F.expr(f"ts + INTERVAL {APPENDED_DAYS_LATER} DAYS"))
    return again.unionByName(later.select(again.columns))


def dated_events(spark, sf_dir):
    """The events by date, with the late rows merged: path and changed days."""
    events, path = read_table(spark, sf_dir, "events"), _folder(spark, "events-by-date")
    partitioned.write_dates(events, path, "ts")
    return path, partitioned.merge_late(spark, path, late_rows(events), "event_id", "ts")


def q_partition_extract(spark, sf_dir):
    """S2 over ingestion-date partitions, late rows included."""
    path, _ = dated_events(spark, sf_dir)
    return partitioned.partition_extract(spark, path, "2024-01-09", "2024-02-05", where="event_type <> 'click'",
                                         tie_col="event_id")


def q_incremental_profile(spark, sf_dir):
    """A8-A9 merged from states per partition, those of changed days made anew."""
    events, path, states = read_table(spark, sf_dir, "events"), _folder(spark, "events-by-date"), _folder(spark, "states")
    partitioned.write_dates(events, path, "ts")
    table_state.write_states(table_state.partition_states(spark.read.parquet(path)), states)
    days = partitioned.merge_late(spark, path, late_rows(events), "event_id", "ts")
    table_state.refresh_states(spark, path, states, days)
    return table_state.merge_states(spark.read.parquet(states))


def q_incremental_freshness(spark, sf_dir):
    """A10-A13 from the same states."""
    path, _ = dated_events(spark, sf_dir)
    states = table_state.partition_states(spark.read.parquet(path)).checkpoint()
    fresh = table_state.freshness_of_states(states, "2024-03-01")
    one = F.lit(1).alias("one")
    return fresh.select("*", one).join(table_state.quality_of_states(states).select("*", one), "one").drop("one")


# ---------------------------------------------------------------- sketches

def q_percentile_sketches(spark, sf_dir):
    """M3: daily quantile sketches merged per event type; whether the rank of
    each percentile, measured over all rows, is within twice the stated bound."""
    e = read_table(spark, sf_dir, "events")
    daily = sketches.quantile_sketches(e, "value", F.to_date("ts"), ["event_type"]).checkpoint()
    measured = sketches.measured_rank_errors(e, "value", sketches.merged_quantiles(daily, ["event_type"]), ["event_type"])
    bound = 2 * sketches.rank_error_bound()
    return measured.select("event_type", "n", *[(F.col(f"e{t}") <= bound).alias(f"p{t}_within") for t in ("50", "95", "99")])


def q_duplicate_sketches(spark, sf_dir):
    """Distinct-row sketches per order year, merged, against the exact
    profile of the same rows; and the rows that two shares of the table have in common."""
    o = read_table(spark, sf_dir, "orders")
    both = o.unionAll(o.where("o_orderstatus = 'P'"))
    bound = sketches.distinct_error_bound()
    estimated = sketches.sketched_row_profile(sketches.row_sketches(both, F.year("o_orderdate")))
    exact = quality.row_profile(both, hashed=True)
    shares = sketches.row_sketches(o, F.lit(0)).unionByName(sketches.row_sketches(o.where("o_orderstatus = 'P'"), F.lit(1)))
    shared = sketches.sketched_overlap(shares).select("shared_rows")
    of_p = o.where("o_orderstatus = 'P'").agg(F.count(F.lit(1)).alias("expected"), F.lit(1).alias("one"))
    one = F.lit(1).alias("one")
    joined = (exact.select("*", one).join(estimated.select(F.col("unique_rows").alias("estimate"), one), "one")
              .join(shared.select("*", one), "one").join(of_p, "one"))
    # An intersection's error is in proportion to the larger set.
    return joined.select("total_rows", "unique_rows", "duplicate_rows",
                         (F.abs(F.col("estimate") - F.col("unique_rows")) <= bound * F.col("unique_rows")).alias("unique_within"),
                         (F.abs(F.col("shared_rows") - F.col("expected")) <= 2 * bound * F.col("unique_rows")).alias("shared_within"))


# ----------------------------------------------------------- checked input

def q_jsonl_rejects(spark, sf_dir):
    """Booking rows as JSON lines, those of orders with three items broken:
    every line is either accepted or in the reject table."""
    b, path = Q.booking_df(spark, sf_dir), _folder(spark, "files")
    line = F.to_json(F.struct(*b.columns))
    b.select(F.when(F.col("n_items") == 3, F.substring(line, 1, 28)).otherwise(line).alias("value")).write.text(path)
    accepted, rejected, _ = files.read_jsonl_checked(spark, path, b.schema, max_reject_share=1.0)
    named = F.regexp_extract("line", r'"booking_id":"(\d+)"', 1)
    return accepted.select("booking_id", F.lit(True).alias("accepted"), F.col("fraud_flag").cast("long").alias("fraud_flag")).unionByName(
        rejected.select(named.alias("booking_id"), F.lit(False).alias("accepted"), F.lit(None).cast("long").alias("fraud_flag")))


PARAMETER_SQL = """SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_value FROM IDENTIFIER(:table)
WHERE value >= :least AND event_type <> :other AND props LIKE :pattern GROUP BY event_type"""


def q_adhoc_sql_parameters(spark, sf_dir):
    """S3 with bound values and a bound table name; a value full of quotes is a value."""
    register_tables(spark, sf_dir, ["events"])
    return execute_query(spark, PARAMETER_SQL, {"table": "events", "least": 10.0, "other": "x' OR '1'='1", "pattern": '{"k":%'})


# ------------------------------------------------------- more than two classes

def priority_predictions(spark, sf_dir):
    """Orders with their priority as label and a rule's guess: right for most
    keys, else by the key, and missing for some."""
    o = read_table(spark, sf_dir, "orders")
    digit = F.substring(F.md5(F.concat(F.lit("p:"), F.col("o_orderkey").cast("string"))), 1, 1)
    other = F.element_at(F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "6-UNKNOWN")]),
                         (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select(F.col("o_orderpriority").alias("label"),
                    F.when(digit < "a", F.col("o_orderpriority")).when(digit < "f", other).alias("guess"))


def q_confusion_cells(spark, sf_dir):
    return multiclass.confusion_cells(priority_predictions(spark, sf_dir), "label", "guess")


def q_multiclass_report(spark, sf_dir):
    return multiclass.multiclass_report(priority_predictions(spark, sf_dir), "label", "guess")


def q_multiclass_report_two(spark, sf_dir):
    """The general report over the two classes of the test rows."""
    return multiclass.multiclass_report(Q.test_scored_df(spark, sf_dir), "fraud_flag", "fraud_prediction")


# ------------------------------------------------------------------ streams

def _stream(spark, path):
    return stream_scoring.read_stream(spark, path, spark.read.parquet(path).schema)


def q_stream_accuracy_trend(spark, sf_dir):
    """M1: scores and labels as two streams; a label later than the bound
    counts as none."""
    base = _folder(spark, "streams")
    scores = Q.timed_predictions(spark, sf_dir)
    known = Q.booking_df(spark, sf_dir).select("booking_id", "fraud_flag").join(
        Q.booking_times(spark, sf_dir), "booking_id").select(
        "booking_id", "fraud_flag", F.expr("booking_ts + make_dt_interval(cast(cast(booking_id as bigint) % 120 as int))").alias("known_ts"))
    for df, ts, name in ((scores, "booking_ts", "scores"), (known, "known_ts", "labels")):
        df.write.parquet(f"{base}/{name}")
        labels.closing_row(df, ts, STREAM_END).write.mode("append").parquet(f"{base}/{name}")
    joined = labels.labelled_scores(_stream(spark, f"{base}/scores"), _stream(spark, f"{base}/labels"), "booking_id",
                                    "booking_ts", "known_ts", "fraud_flag", f"{LABEL_WITHIN_DAYS} DAYS")
    labels.start_labelled_sink(joined, f"{base}/out", f"{base}/ckpt").awaitTermination()
    rows = spark.read.parquet(f"{base}/out").where("booking_id IS NOT NULL")
    return labels.accuracy_of_labelled(rows, "booking_ts", "fraud_flag")


def q_stream_scores_once(spark, sf_dir):
    """M5: every source file arrives twice; one scored row per booking."""
    base = _folder(spark, "streams")
    b = Q.booking_df(spark, sf_dir).join(Q.booking_times(spark, sf_dir), "booking_id")
    for _ in range(2):
        b.write.mode("append").parquet(f"{base}/in")
    source = once.first_arrivals(_stream(spark, f"{base}/in"), "booking_id", "booking_ts")
    pred = stream_scoring.stream_predictions(source, scorer=lambda d: Q.scored_df(spark, sf_dir, d),
                                             scored_at=F.lit(Q.SCORED_AT))
    once.start_keyed_sink(pred, f"{base}/out", f"{base}/ckpt").awaitTermination()
    return once.read_keyed(spark, f"{base}/out", ["booking_id"])


def q_stream_score_drift(spark, sf_dir):
    """M6 / M7: score histograms of hopping windows against the scores of the
    baseline year, read after the batch folders were compacted."""
    base = _folder(spark, "streams")
    scores = Q.timed_predictions(spark, sf_dir).select("booking_ts", "fraud_probability")
    scores.write.parquet(f"{base}/in")
    baseline = drift.baseline_histogram(scores.where(F.year("booking_ts") == Q.PSI_BASELINE), "fraud_probability").checkpoint()
    histogram = drift.windowed_histogram(_stream(spark, f"{base}/in"), "booking_ts", "fraud_probability",
                                         f"{DRIFT_WINDOW_DAYS} days", f"{DRIFT_SLIDE_DAYS} days")
    monitors.start_monitor_sink(histogram, f"{base}/out", f"{base}/ckpt").awaitTermination()
    keys = [*monitors.WINDOW_KEYS, "bin"]
    monitors.compact_monitor(spark, f"{base}/out", keys)
    return drift.windowed_psi(monitors.read_monitor(spark, f"{base}/out", keys), baseline)


# ------------------------------------------------------ reports as plain rows

def q_evaluation_report_rows(spark, sf_dir):
    """K4: the nested report written as JSON, read back and flattened."""
    m = metrics.evaluation_metrics(Q.test_scored_df(spark, sf_dir), "fraud_flag", "fraud_probability")
    report = metrics.evaluation_report(m, "fixed_score_ensemble")
    path = writers.write_report_json(report, _folder(spark, "files"))
    back = spark.read.schema(report.schema).json(path)
    return back.select("model_name", "metrics.*", "confusion_matrix.*", "business_impact.*",
                       *[F.col("classification_report")[k][c].alias(f"{c}_{k}") for k in range(5)
                         for c in ("class_label", "precision", "support")])


def q_performance_log(spark, sf_dir):
    """K5: two appended rows of the performance log, their JSON metrics read back."""
    m = metrics.evaluation_metrics(Q.test_scored_df(spark, sf_dir), "fraud_flag", "fraud_probability").checkpoint()
    path = _folder(spark, "files")
    for version in ("v1", "v2"):
        writers.log_performance(m, path, "fixed_score_ensemble", version, logged_at=Q.SCORED_AT)
    value = F.from_json("metrics", "map<string,double>")
    return spark.read.parquet(path).select("model_name", "version", "timestamp", F.explode(value).alias("metric", "value"))


def q_table_schemas(spark, sf_dir):
    """Name, row count and columns of each table, from its metadata record."""
    out = None
    for name in ("orders", "lineitem", "events", "documents"):
        m = metadata.table_metadata(read_table(spark, sf_dir, name), name)
        m = m.select("table_name", "row_count", "column_count", F.posexplode("schema").alias("position", "column"))
        m = m.select("table_name", "row_count", "column_count", (F.col("position") + 1).alias("position"), F.col("column.name").alias("name"))
        out = m if out is None else out.unionByName(m)
    return out


def q_explanation_checks(spark, sf_dir):
    """Per member the test rows explained, and those whose base and
    contributions do not sum to the member's raw score."""
    model, _, _ = Q.fitted_ensemble(spark, sf_dir)
    test = Q.split_df(spark, sf_dir).where("split = 'test'").drop("split")
    path = models.save_model(model, _folder(spark, "models"))
    sums = (explain.explanations(spark, model, path, test).groupBy("booking_id", "member")
            .agg(F.sum("contribution").alias("explained")))
    both = explain.raw_scores(model, test).join(sums, ["booking_id", "member"], "left")
    off = F.coalesce(F.abs(F.col("raw") - F.col("explained")) > 1e-6 * (1 + F.abs("raw")), F.lit(True))
    return both.groupBy("member").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(off).alias("n_off"))


QUERIES = {
    "explanation_checks": q_explanation_checks,
    "score_table_nan": q_score_table_nan,
    "evaluation_metrics_nan": q_evaluation_metrics_nan,
    "percentiles_nan": q_percentiles_nan,
    "psi_nan": q_psi_nan,
    "prediction_versions": q_prediction_versions,
    "partition_extract": q_partition_extract,
    "incremental_profile": q_incremental_profile,
    "incremental_freshness": q_incremental_freshness,
    "percentile_sketches": q_percentile_sketches,
    "duplicate_sketches": q_duplicate_sketches,
    "jsonl_rejects": q_jsonl_rejects,
    "adhoc_sql_parameters": q_adhoc_sql_parameters,
    "confusion_cells": q_confusion_cells,
    "multiclass_report": q_multiclass_report,
    "multiclass_report_two": q_multiclass_report_two,
    "stream_accuracy_trend": q_stream_accuracy_trend,
    "stream_scores_once": q_stream_scores_once,
    "stream_score_drift": q_stream_score_drift,
    "evaluation_report_rows": q_evaluation_report_rows,
    "performance_log": q_performance_log,
    "table_schemas": q_table_schemas,
}

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import metrics, scoring
from riskloom.plans import queries as Q
from riskloom.sinks import writers
from riskloom.sources import extract, files, metadata

SF = "/root/testdata/sf0.001"


def test_prediction_table_overwrite_roundtrip(spark, tmp_dir):
    pred = Q.predictions_df(spark, SF)
    path = os.path.join(tmp_dir, "pred")
    writers.write_predictions(pred, path)
    writers.write_predictions(pred.limit(5), path)  # truncate-and-load
    back = spark.read.parquet(path)
    assert back.count() == 5 and back.columns == [f.name for f in scoring.PREDICTION_SCHEMA]


def test_csv_export_roundtrip(spark, tmp_dir):
    b = Q.booking_df(spark, SF)
    p = writers.write_csv(b, os.path.join(tmp_dir, "csv"))
    back = files.read_csv_dataset(spark, p, b.schema)
    assert back.exceptAll(b).count() == 0 and b.exceptAll(back).count() == 0
    inferred = files.read_csv_dataset(spark, p)
    assert inferred.columns == b.columns


@pytest.mark.parametrize("fmt", ["CSV", "JSON", "NEWLINE_DELIMITED_JSON", "PARQUET", "parquet"])
def test_export_formats(spark, tmp_dir, fmt):
    df = spark.read.parquet(f"{SF}/region.parquet")
    p = writers.export_table(df, os.path.join(tmp_dir, fmt), fmt)
    src = {"CSV": "csv", "JSON": "json", "NEWLINE_DELIMITED_JSON": "json"}.get(fmt.upper(), "parquet")
    r = spark.read.format(src).option("header", True).load(p)
    assert r.count() == 5


def test_export_rejects_unknown(spark, tmp_dir):
    with pytest.raises(ValueError):
        writers.export_table(spark.range(1), os.path.join(tmp_dir, "x"), "XLSX")


def test_report_json_and_performance_log(spark, tmp_dir):
    m = metrics.evaluation_metrics(Q.test_scored_df(spark, SF), "fraud_flag", "fraud_probability")
    rep = metrics.evaluation_report(m, "model_x")
    p = writers.write_report_json(rep, os.path.join(tmp_dir, "report"))
    doc = json.loads(spark.read.text(p).first()["value"])
    assert doc["model_name"] == "model_x"
    assert set(doc["confusion_matrix"]) == {"true_negatives", "false_positives", "false_negatives", "true_positives"}
    assert [c["class_label"] for c in doc["classification_report"]] == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    log = os.path.join(tmp_dir, "perf")
    writers.log_performance(m, log, "model_x", "1", logged_at="2024-02-01 00:00:00")
    writers.log_performance(m, log, "model_x", "2", logged_at="2024-02-02 00:00:00")
    rows = spark.read.parquet(log).orderBy("version").collect()
    assert [r["version"] for r in rows] == ["1", "2"]
    assert rows[0]["timestamp"] == "2024-02-01T00:00:00"
    assert json.loads(rows[0]["metrics"])["roc_auc"] == m.first()["roc_auc"]


def test_instances_source(spark, tmp_dir):
    p = os.path.join(tmp_dir, "req.json")
    with open(p, "w") as fh:
        json.dump({"instances": [{"qty_sum": 150.0, "avg_discount": 0.08}, {"qty_sum": 10.0, "avg_discount": 0.0}]}, fh)
    rows = files.read_instances(spark, p).collect()
    assert len(rows) == 2 and rows[0]["qty_sum"] == 150.0
    bad = os.path.join(tmp_dir, "bad.json")
    with open(bad, "w") as fh:
        json.dump({"rows": []}, fh)
    with pytest.raises(ValueError, match="instances"):
        files.read_instances(spark, bad)


def test_jsonl_source(spark, tmp_dir):
    b = Q.booking_df(spark, SF)
    p = os.path.join(tmp_dir, "jsonl")
    b.write.json(p)
    assert files.read_jsonl(spark, p, b.schema).count() == b.count()


def test_training_view_keeps_existing(spark):
    b = Q.booking_df(spark, SF)
    extract.create_training_view(spark, b, "tv_keep", ["qty_sum"], "fraud_flag", "qty_sum > 100")
    extract.create_training_view(spark, b, "tv_keep", ["qty_sum"], "fraud_flag", "qty_sum > 0")
    assert spark.table("tv_keep").where("qty_sum <= 100").count() == 0


def test_extract_or_predicate_is_parenthesised(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    out = extract.training_extract(e, "ts", "2024-01-10", "2024-01-10", where="1 = 1 OR 1 = 1")
    assert out.where(F.to_date("ts") != F.lit("2024-01-10").cast("date")).count() == 0


def test_extract_limit_is_topk(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    out = extract.training_extract(e, "ts", limit=10, tie_col="event_id")
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 10


def test_table_metadata_bytes(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    r = metadata.table_metadata(df, "lineitem").first()
    size = os.path.getsize(f"{SF}/lineitem.parquet")
    assert r["size_bytes"] == size and r["size_mb"] == round(size / 1024 / 1024, 2)
    assert r["row_count"] == df.count() and r["column_count"] == len(df.columns)
    assert r["schema"][0]["name"] == "l_orderkey"


def test_dataset_listing_is_one_record(spark):
    spark.range(1).createOrReplaceTempView("listed_view")
    r = metadata.dataset_listing(spark).first()
    assert r["table_count"] == len(r["tables"]) and "listed_view" in r["tables"]


def test_list_tables(spark):
    spark.range(3).createOrReplaceTempView("tiny_listed")
    names = [r["name"] for r in metadata.list_tables(spark).collect()]
    assert "tiny_listed" in names


def test_table_metadata_times(spark):
    import datetime as dt
    df = spark.read.parquet(f"{SF}/orders.parquet")
    r = metadata.table_metadata(df, "orders").first()
    mtime = dt.datetime.fromtimestamp(os.path.getmtime(f"{SF}/orders.parquet"), dt.timezone.utc).replace(tzinfo=None)
    assert abs((r["modified"] - mtime).total_seconds()) < 1 and r["created"] == r["modified"]


def test_extract_prunes_date_partitions(spark, tmp_dir):
    """P5 on a partition column (the reference filters on its ingestion-time
    partition): the inclusive date range becomes a partition filter, so
    partitions outside it are not listed or read."""
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("dt", F.to_date("ts"))
    path = os.path.join(tmp_dir, "events_by_day")
    e.write.partitionBy("dt").parquet(path)
    part = spark.read.parquet(path)
    out = extract.training_extract(part, "dt", "2024-01-10", "2024-01-12", tie_col="event_id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "dt#" in plan
    expect = e.where("dt between '2024-01-10' and '2024-01-12'").count()
    assert out.count() == expect
    files_read = out.select(F.input_file_name()).distinct().count()
    assert files_read <= 3 * 8


def test_catalog_table_view_and_prediction_table(spark):
    """K7 for catalog tables (persistent view, kept if it exists) and K1 as a
    catalog table overwrite."""
    b = Q.booking_df(spark, SF)
    b.write.mode("overwrite").saveAsTable("booking_tbl")
    extract.create_training_view_sql(spark, "booking_tbl", "booking_train_v", ["qty_sum", "n_items"], "fraud_flag",
                                     "qty_sum > 100")
    extract.create_training_view_sql(spark, "booking_tbl", "booking_train_v", ["qty_sum"], "fraud_flag")
    v = spark.table("booking_train_v")
    assert v.columns == ["qty_sum", "n_items", "fraud_flag"]
    assert v.count() == b.where("qty_sum > 100").count()
    names = [r["name"] for r in metadata.list_tables(spark, "default").collect()]
    assert "booking_tbl" in names and "booking_train_v" in names
    writers.save_predictions_table(Q.predictions_df(spark, SF), "predictions_tbl")
    writers.save_predictions_table(Q.predictions_df(spark, SF).limit(3), "predictions_tbl")
    assert spark.table("predictions_tbl").count() == 3


def test_instance_documents_roundtrip(spark, tmp_dir):
    """S6 writer: at most ``per_document`` instances per document, one
    document per line, and the rows come back whole."""
    b = Q.booking_df(spark, SF)
    path = os.path.join(tmp_dir, "docs")
    writers.write_instance_documents(b, path, per_document=100)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert len(lines) >= b.count() / 100
    assert all(0 < len(json.loads(line)["instances"]) <= 100 for line in lines)
    back = files.read_instances(spark, path, b.schema, lines=True)
    assert back.columns == b.columns
    assert back.exceptAll(b).count() == 0 and b.exceptAll(back).count() == 0


@pytest.mark.parametrize("schema", [None, T.StructType([T.StructField("a", T.LongType())])])
@pytest.mark.parametrize("bad", ['{"rows": [{"a": 1}]}', '{"instances": [{"a": 1}', '{"instances": null}'])
def test_request_documents_that_are_not_whole_fail(spark, tmp_dir, schema, bad):
    for name, text in (("a.json", '{"instances": [{"a": 1}]}'), ("b.json", bad)):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    with pytest.raises(Exception):
        files.read_instances(spark, tmp_dir, schema).collect()


def test_broken_lines_and_cells_fail(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.jsonl"), "w") as f:
        f.write('{"a": 1}\n{"a": \n')
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("a,b\n1,2\nx,3\n")
    with pytest.raises(Exception):
        files.read_jsonl(spark, os.path.join(tmp_dir, "a.jsonl"), "a long").collect()
    with pytest.raises(Exception):
        files.read_csv_dataset(spark, os.path.join(tmp_dir, "a.csv"), "a long, b long").collect()

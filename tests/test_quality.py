import datetime as dt

from pyspark.sql import functions as F

from riskloom.operators import quality


def _events(spark, days_ago, as_of="2024-01-31"):
    base = dt.datetime.fromisoformat(as_of)
    rows = [(i, base - dt.timedelta(days=d) + dt.timedelta(hours=1)) for i, d in enumerate(days_ago)]
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz")


def test_freshness_status_boundaries(spark):
    expect = {0: "Current", 1: "Recent", 7: "Stale", 8: "Very Stale"}
    for days, status in expect.items():
        df = _events(spark, [days, days + 3])
        r = quality.freshness_summary(df, "ts", "2024-01-31").first()
        assert r["days_since_last_update"] == days
        assert r["freshness_status"] == status


def test_freshness_no_data(spark):
    df = _events(spark, [45])  # outside the 30-day lookback
    r = quality.freshness_summary(df, "ts", "2024-01-31").first()
    assert r["days_with_data"] == 0
    assert r["days_since_last_update"] is None
    assert r["freshness_status"] == "No Data"


def test_freshness_filter_is_pushed(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = quality.daily_counts(df, "ts", "2024-01-31")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_quality_report_counts_and_assessment(spark):
    df = spark.createDataFrame([("a", 1.0), ("", None), (None, None), ("b", 2.0)], "s string, x double")
    r = quality.quality_report(df).first()
    assert r["total_rows"] == 4
    assert r["s_nulls"] == 1 and r["s_empty"] == 2 and r["x_nulls"] == 2
    assert r["s_null_pct"] == 25.0 and r["x_null_pct"] == 50.0 and r["s_empty_pct"] == 50.0
    assert r["quality_score"] == 62.5 and r["assessment"] == "Fair"
    assert "x_empty" not in r.asDict()


def test_quality_report_empty_table(spark):
    df = spark.createDataFrame([], "s string, x double")
    r = quality.quality_report(df).first()
    assert r["total_rows"] == 0 and r["s_null_pct"] is None
    assert r["quality_score"] == 100.0 and r["assessment"] == "No Data"


def test_row_profile_nulls_compare_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (2, "x"), (3, "y")], "a int, b string")
    r = quality.row_profile(df).first()
    assert (r["total_rows"], r["unique_rows"], r["duplicate_rows"]) == (6, 3, 3)


def test_validation_gate(spark):
    rows = [(i, None if i % 5 == 0 else "v") for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string")
    r = quality.validation_gate(df).first()
    assert r["row_count"] == 1000 and r["column_count"] == 2
    assert r["null_percentage"] == 0.1 and r["duplicate_rows"] == 0 and r["is_valid"] is True
    r2 = quality.validation_gate(df.limit(999), min_rows=1000).first()
    assert r2["is_valid"] is False
    r3 = quality.validation_gate(df, max_null_fraction=0.09).first()
    assert r3["is_valid"] is False


def test_validation_gate_empty(spark):
    r = quality.validation_gate(spark.createDataFrame([], "a int")).first()
    assert r["row_count"] == 0 and r["null_percentage"] is None and r["is_valid"] is False


def test_null_drop(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (4, "d")], "a int, b string")
    assert sorted(r["a"] for r in quality.drop_null_rows(df).collect()) == [1, 4]
    r = quality.null_drop_report(df).first()
    assert (r["initial_rows"], r["rows_after_cleaning"], r["removed_rows"]) == (4, 2, 2)
    assert F is not None


def test_column_profile_long_form(spark):
    df = spark.createDataFrame([("a", 1.0), ("", None), (None, None), ("b", 2.0)], "s string, x double")
    rows = {r["column_name"]: r for r in quality.column_profile(df).collect()}
    assert rows["s"]["nulls"] == 1 and rows["s"]["empties"] == 2 and rows["s"]["empty_pct"] == 50.0
    assert rows["x"]["nulls"] == 2 and rows["x"]["null_pct"] == 50.0 and rows["x"]["empties"] is None
    assert all(r["total_rows"] == 4 for r in rows.values())


def test_column_profile_matches_wide_report(spark):
    from riskloom.sources import derived
    o = derived.orders_with_gaps(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"))
    wide = quality.quality_report(o).first().asDict()
    for r in quality.column_profile(o).collect():
        assert wide[f"{r['column_name']}_nulls"] == r["nulls"]
        assert wide[f"{r['column_name']}_null_pct"] == r["null_pct"]


def test_wide_quality_report_path_matches(spark):
    """The report assembled from the long profile (used for wide tables)
    equals the single-aggregation report, also on an empty table."""
    from riskloom.sources import derived
    o = derived.orders_with_gaps(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"))
    for frame in (o, o.limit(0)):
        a = quality.quality_report(frame)
        b = quality.quality_report(frame, wide_limit=1)
        assert a.columns == b.columns
        assert a.first().asDict() == b.first().asDict()


def test_wide_quality_report_on_many_columns(spark):
    cols = [F.when(F.col("id") % (i + 2) == 0, None).otherwise(F.col("id")).alias(f"c{i}") for i in range(400)]
    df = spark.range(50).select(*cols)
    r = quality.quality_report(df).first()
    assert r["total_rows"] == 50 and r["c0_nulls"] == 25 and r["c399_nulls"] == 1


def test_hashed_duplicate_counting_equals_exact(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").drop("doc_id")
    assert quality.row_profile(docs).first() == quality.row_profile(docs, hashed=True).first()
    df = spark.createDataFrame([(1, None), (1, None), (None, "x"), (2, "x")], "a int, b string")
    assert quality.validation_gate(df, 1).first() == quality.validation_gate(df, 1, hashed=True).first()


def test_gate_compares_the_unrounded_fraction(spark):
    """300,001 NULLs in 3,000,000 cells are over a limit of 0.1."""
    df = spark.range(1_000_000).select(F.col("id"), F.when(F.col("id") >= 300_001, F.col("id")).alias("a"), F.lit(1).alias("b"))
    got = quality.validation_gate(df).first()
    assert got.null_percentage == 0.1 and not got.is_valid


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x double, s string")
    assert quality.drop_null_rows(df).count() == 1
    assert tuple(quality.null_drop_report(df).first()) == (3, 1, 2)
    assert quality.validation_gate(df).first().null_percentage == round(2 / 6, 6)


def test_digest_tells_microseconds_apart(spark):
    df = spark.sql("""SELECT * FROM VALUES (timestamp_ntz'2024-01-01 00:00:00.000001', array(timestamp'2024-01-01 00:00:00.000001'), 'a', null),
                      (timestamp_ntz'2024-01-01 00:00:00.000002', array(timestamp'2024-01-01 00:00:00.000001'), 'a', null),
                      (timestamp_ntz'2024-01-01 00:00:00.000002', array(timestamp'2024-01-01 00:00:00.000002'), 'a', null),
                      (timestamp_ntz'2024-01-01 00:00:00.000002', array(timestamp'2024-01-01 00:00:00.000002'), null, 'a'),
                      (timestamp_ntz'2024-01-01 00:00:00.000002', array(timestamp'2024-01-01 00:00:00.000002'), null, 'a') AS t(a, b, c, d)""")
    assert tuple(quality.row_profile(df.select("a", "c", "d"), hashed=True).first()) == (5, 3, 2)
    assert tuple(quality.row_profile(df, hashed=True).first()) == (5, 4, 1)


def test_an_empty_table_has_no_quality(spark):
    assert quality.quality_report(spark.createDataFrame([], "a long, b string")).first().assessment == "No Data"

import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import prep
from riskloom.plans import queries as Q

SF = "/root/testdata/sf0.001"


def test_split_is_exact_disjoint_and_complete(spark):
    b = Q.booking_df(spark, SF)
    s = prep.stratified_split(b, "fraud_flag", "booking_id", 0.3, 42)
    rows = s.groupBy("fraud_flag", "split").count().collect()
    per = {(r["fraud_flag"], r["split"]): r["count"] for r in rows}
    for c in (0, 1):
        n = per.get((c, "train"), 0) + per.get((c, "test"), 0)
        assert abs(per.get((c, "test"), 0) - n * 0.3) <= 1
    assert per[(0, "test")] + per[(1, "test")] == math.ceil(b.count() * 3 / 10)
    assert s.count() == b.count()
    assert s.select("booking_id").distinct().count() == b.count()


def test_split_small_buckets_match_large_buckets(spark, monkeypatch):
    """The bucketed plan gives the same split for any bucket width."""
    b = Q.booking_df(spark, SF)
    a = prep.stratified_split(b, "fraud_flag", "booking_id", 0.25, 7)
    monkeypatch.setattr(prep, "ROWS_PER_SPLIT_BUCKET", 1)
    c = prep.stratified_split(b, "fraud_flag", "booking_id", 0.25, 7)
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_split_reproducible_and_seed_sensitive(spark):
    b = Q.booking_df(spark, SF)
    s1 = prep.stratified_split(b, "fraud_flag", "booking_id", 0.3, 42).where("split='test'")
    s2 = prep.stratified_split(b, "fraud_flag", "booking_id", 0.3, 42).where("split='test'")
    s3 = prep.stratified_split(b, "fraud_flag", "booking_id", 0.3, 43).where("split='test'")
    assert s1.exceptAll(s2).count() == 0
    assert s1.exceptAll(s3).count() > 0


def test_split_multiclass_and_null_label(spark):
    """Seven classes plus a NULL class: each class is split exactly and no
    row is lost."""
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 8 == 7, F.lit(None)).otherwise(F.col("id") % 8).cast("int").alias("y"))
    s = prep.stratified_split(df, "y", "id", 0.3, 5)
    assert s.count() == 3000
    per = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    for c in [*range(7), None]:
        n = per.get((c, "train"), 0) + per.get((c, "test"), 0)
        assert n > 0 and abs(per.get((c, "test"), 0) - n * 0.3) <= 1
    assert sum(k for (_, side), k in per.items() if side == "test") == 900


def test_split_of_null_and_repeated_keys(spark):
    """No row is lost and sizes are exact whatever the keys: all NULL, all
    the same, few distinct, or none given."""
    base = spark.range(1000).repartition(7)
    for key in (F.lit(None).cast("string"), F.lit("k"), (F.col("id") % 10).cast("string")):
        df = base.select(key.alias("id"), (F.col("id") % 2).alias("y"))
        s = prep.stratified_split(df, "y", "id", 0.35, 3)
        got = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
        assert got == {(y, side): n for y in (0, 1) for side, n in (("test", 175), ("train", 325))}
    bare = prep.stratified_split(base.select((F.col("id") % 2).alias("y")), "y", None, 0.29)
    assert bare.where("split = 'test'").count() == 290 and bare.columns == ["y", "split"]


def test_split_sizes_are_whole_numbers(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("y"))
    assert prep.stratified_split(df, "y", "id", 0.29).where("split='test'").count() == 29


def test_split_joins_the_table_on_class_and_bucket(spark):
    """The full table meets only the per-(class, bucket) verdict table, on
    both keys — never a join on the class alone."""
    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    s = prep.stratified_split(o, "y", "o_orderkey", 0.3, 42)
    top = s._jdf.queryExecution().optimizedPlan().toString().split("\n")
    first_join = next(line for line in top if "Join" in line)
    assert "<=>" in first_join and "_b" in first_join and "_tb" in first_join
    per = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    for c in (0, 1):
        assert abs(per[(c, "test")] - (per[(c, "test")] + per[(c, "train")]) * 0.3) <= 1


def test_split_edges(spark):
    df = spark.createDataFrame([(str(i), 0) for i in range(10)], "id string, y int")
    assert prep.stratified_split(df, "y", "id", 0.0).where("split='test'").count() == 0
    assert prep.stratified_split(df, "y", "id", 1.0).where("split='test'").count() == 10
    with pytest.raises(ValueError):
        prep.stratified_split(df, "y", "id", 1.5)


def test_class_balance(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "fraud_flag int")
    r = prep.class_balance(df).first()
    assert r["fraud_ratio"] == 0.25 and r["scale_pos_weight"] == 3.0
    assert r["weight_positive"] == 2.0 and r["weight_negative"] == pytest.approx(0.666667)


def test_class_balance_single_class(spark):
    df = spark.createDataFrame([(0,), (0,)], "fraud_flag int")
    r = prep.class_balance(df).first()
    assert r["n_positive"] == 0 and r["scale_pos_weight"] is None and r["weight_positive"] is None


def test_features_and_required_columns(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 1)], "booking_id string, x int, z double, fraud_flag int")
    assert prep.feature_columns(df) == ["x", "z"]
    with pytest.raises(ValueError, match="Missing features"):
        prep.require_columns(df, ["x", "nope"])
    assert prep.select_features(df, ["z", "x"], keep=["booking_id"]).columns == ["booking_id", "z", "x"]
    assert F is not None

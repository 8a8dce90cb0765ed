import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import metrics, monitoring
from riskloom.operators.ranking import running_totals


def _brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(ys, ss):
    order = sorted(set(ss), reverse=True)
    P = sum(ys)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


@pytest.mark.parametrize("n_buckets", [1, 3, 16])
def test_auc_ap_against_brute_force_with_ties(spark, n_buckets):
    rnd = random.Random(5)
    ys = [rnd.randint(0, 1) for _ in range(300)]
    ss = [round(rnd.random(), 1) for _ in range(300)]  # many ties
    df = spark.createDataFrame(list(zip(ys, ss)), "y int, s double")
    r = metrics.ranking_metrics(df, "y", "s", n_buckets=n_buckets).first()
    assert r["roc_auc"] == pytest.approx(_brute_auc(ys, ss), abs=1e-6)
    assert r["pr_auc"] == pytest.approx(_brute_ap(ys, ss), abs=1e-6)


def test_auc_invariant_under_monotone_map(spark):
    rnd = random.Random(9)
    rows = [(rnd.randint(0, 1), rnd.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, "y int, s double")
    a = metrics.ranking_metrics(df, "y", "s").first()
    b = metrics.ranking_metrics(df.withColumn("s", F.exp(F.col("s") * 3)), "y", "s").first()
    assert a["roc_auc"] == b["roc_auc"] and a["pr_auc"] == b["pr_auc"]


def test_all_tied_and_single_class(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "y int, s double")
    r = metrics.ranking_metrics(df, "y", "s").first()
    assert r["roc_auc"] == 0.5 and r["pr_auc"] == 0.5
    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, s double")
    r1 = metrics.ranking_metrics(one, "y", "s").first()
    assert r1["roc_auc"] is None and r1["pr_auc"] == 1.0


def test_roc_curve_points(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "y int, s double")
    pts = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, "y", "s", drop_intermediate=False).collect())
    assert pts == [(0.0, 0.0), (0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_confusion_report_and_impact(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "y int, p int")
    c = metrics.confusion_metrics(df, "y", "p")
    r = c.first()
    assert (r["true_negatives"], r["false_positives"], r["false_negatives"], r["true_positives"]) == (4, 2, 1, 3)
    assert r["accuracy"] == 0.7 and r["precision"] == 0.6 and r["recall"] == 0.75
    assert r["f1_score"] == pytest.approx(2 * 0.6 * 0.75 / 1.35, abs=1e-6)
    b = metrics.business_impact(c).first()
    assert b["net_benefit"] == 3 * 1000 - 2 * 50 - 1 * 1000
    rep = {x["class_label"]: x for x in metrics.class_report(c).collect()}
    assert rep["0"]["support"] == 6 and rep["1"]["support"] == 4
    assert rep["accuracy"]["f1_score"] == 0.7 and rep["accuracy"]["precision"] is None


def test_zero_division_guards(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = metrics.confusion_metrics(df, "y", "p").first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1_score"] == 0.0 and r["accuracy"] == 1.0


def test_running_totals_against_cumsum(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), rnd.randint(0, 50), rnd.randint(1, 5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, v int").groupBy("g", "k").agg(F.sum("v").alias("v"))
    out = running_totals(df, "k", ["v"], by=["g"], n_buckets=7).collect()
    for r in out:
        exp = sum(v for g, k, v in rows if g == r["g"] and k <= r["k"])
        tot = sum(v for g, k, v in rows if g == r["g"])
        assert r["cum_v"] == exp and r["total_v"] == tot


@pytest.mark.parametrize("rows_per_bucket", [40, 10**6])
def test_running_totals_ranges_sized_from_data(spark, rows_per_bucket):
    """Default range count (one per ``rows_per_bucket`` rows, cut points from
    a quantile pass) against a single range: same totals, next values too."""
    rnd = random.Random(5)
    keys = rnd.sample(range(100000), 900)
    df = spark.createDataFrame([(k * 0.5, rnd.randint(1, 9)) for k in keys], "k double, v int")
    got = {r["k"]: (r["cum_v"], r["total_v"], r["next_v"])
           for r in running_totals(df, "k", ["v"], rows_per_bucket=rows_per_bucket, with_next=True).collect()}
    exp = {r["k"]: (r["cum_v"], r["total_v"], r["next_v"])
           for r in running_totals(df, "k", ["v"], n_buckets=1, with_next=True).collect()}
    assert got == exp and len(got) == 900


@pytest.mark.parametrize("n_buckets", [1, 5, 32])
def test_exact_percentiles_against_numpy(spark, n_buckets):
    rnd = random.Random(11)
    rows = [(rnd.choice(["x", "y", "z"]), float(rnd.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in monitoring.exact_percentiles(df, "v", by=["g"], n_buckets=n_buckets).collect()}
    for g in "xyz":
        vals = np.array([v for gg, v in rows if gg == g])
        for p, col in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
            assert got[g][col] == pytest.approx(round(float(np.quantile(vals, p)), 6), abs=1e-6)
        assert got[g]["n"] == len(vals)


def test_psi_identical_periods_is_zero(spark):
    rows = [(y, s / 20.0) for y in (1, 2) for s in range(20)]
    df = spark.createDataFrame(rows, "year int, s double")
    t = monitoring.psi_total(monitoring.psi(df, "s", "year", 1, 2)).first()
    assert t["psi"] == 0.0 and t["n_bins"] == 10


def _roc_drop_intermediate(ys, ss):
    """The documented rule: cumulative fps/tps over distinct thresholds
    (descending); keep first, last and every point where the second
    difference of fps or tps is non-zero; prepend the origin."""
    ys, ss = np.asarray(ys), np.asarray(ss)
    thr = np.unique(ss)[::-1]
    tps = np.array([((ss >= t) & (ys == 1)).sum() for t in thr])
    fps = np.array([((ss >= t) & (ys == 0)).sum() for t in thr])
    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    pts = [(0.0, 0.0)] + [(round(f / fps[-1], 6), round(t / tps[-1], 6)) for f, t in zip(fps[keep], tps[keep])]
    return sorted(pts)


@pytest.mark.parametrize("n_buckets", [1, 4, 16])
def test_roc_drop_intermediate_matches_rule(spark, n_buckets):
    rnd = random.Random(21)
    ys = [rnd.randint(0, 1) for _ in range(400)]
    ss = [round(rnd.random(), 2) for _ in range(400)]
    df = spark.createDataFrame(list(zip(ys, ss)), "y int, s double")
    got = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, "y", "s", n_buckets=n_buckets).collect())
    assert got == _roc_drop_intermediate(ys, ss)
    full = metrics.roc_curve(df, "y", "s", n_buckets=n_buckets, drop_intermediate=False).count()
    assert full == len(set(ss)) + 1 > len(got)


def test_running_totals_next_across_ranges(spark):
    rows = [(k, k * 10) for k in range(50)]
    df = spark.createDataFrame(rows, "k int, v int")
    out = {r["k"]: r["next_v"] for r in running_totals(df, "k", ["v"], n_buckets=7, with_next=True).collect()}
    assert all(out[k] == (k + 1) * 10 for k in range(49)) and out[49] is None


def test_bucket_binary_search_matches_count(spark):
    from riskloom.operators.ranking import _with_bucket
    rnd = random.Random(2)
    bounds = sorted(rnd.choice([1.0, 2.0, 2.0, 3.5, 7.0, 7.0, 9.0, 12.0]) for _ in range(13))
    keys = [float(k) / 2 for k in range(-2, 30)]
    df = spark.createDataFrame([(k,) for k in keys], "k double")
    out = _with_bucket(df, "k", F.array(*[F.lit(b) for b in bounds]), len(bounds)).collect()
    assert all(r["_b"] == sum(1 for b in bounds if b < r["k"]) for r in out)
    one = _with_bucket(df, "k", F.array(F.lit(3.0)), 1).collect()
    assert all(r["_b"] == (1 if r["k"] > 3.0 else 0) for r in one)


def test_running_totals_sizes_ranges_from_data(spark):
    from riskloom.operators.ranking import buckets_for
    assert buckets_for(0) == 1 and buckets_for(1_000_000) == 1 and buckets_for(1_000_001) == 2
    rnd = random.Random(8)
    rows = [(rnd.choice("ab"), k, rnd.randint(1, 3)) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    out = running_totals(df, "k", ["v"], by=["g"], rows_per_bucket=25, with_next=True).collect()
    for r in out:
        assert r["cum_v"] == sum(v for g, k, v in rows if g == r["g"] and k <= r["k"])
        nxt = [v for g, k, v in sorted(rows, key=lambda t: t[1]) if g == r["g"] and k > r["k"]]
        assert r["next_v"] == (nxt[0] if nxt else None)


def test_ranking_of_billions_of_rows(spark):
    """5e9 rows a class: no product of counts may overflow 64 bits."""
    n = 5 * 10**9
    r = spark.createDataFrame([(0.9, n, 0, n, 0, n, n), (0.1, 0, n, n, n, n, n)],
                              "score double, pos long, neg long, cum_pos long, cum_neg long, total_pos long, total_neg long")
    got = metrics.ranking_from_totals(r).first()
    assert (got.roc_auc, got.pr_auc, got.n_positive) == (1.0, 1.0, n)

"""Property tests (hypothesis) for the distributed ranking primitives
against plain Python on small random inputs."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskloom.operators import metrics, monitoring, prep

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30)), min_size=2, max_size=80)


@settings(**SETTINGS)
@given(rows=rows_st, n_buckets=st.integers(1, 9))
def test_auc_matches_pairwise_definition(spark, rows, n_buckets):
    ys = [y for y, _ in rows]
    if len(set(ys)) < 2:
        return
    df = spark.createDataFrame([(y, float(s)) for y, s in rows], "y int, s double")
    got = metrics.ranking_metrics(df, "y", "s", n_buckets=n_buckets).first()["roc_auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    exp = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(round(exp, 6), abs=1e-6)


@settings(**SETTINGS)
@given(vals=st.lists(st.integers(-20, 20), min_size=1, max_size=60), n_buckets=st.integers(1, 9))
def test_percentiles_match_linear_interpolation(spark, vals, n_buckets):
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    r = monitoring.exact_percentiles(df, "v", n_buckets=n_buckets).first()
    for p, col in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
        assert r[col] == pytest.approx(round(float(np.quantile(vals, p)), 6), abs=1e-6)


@settings(**SETTINGS)
@given(labels=st.lists(st.integers(0, 2), min_size=1, max_size=60),
       frac=st.sampled_from([0.0, 0.1, 0.29, 0.3, 0.5, 0.99]))
def test_split_counts_and_order(spark, labels, frac):
    import hashlib
    import math
    from fractions import Fraction
    rows = [(str(i), y) for i, y in enumerate(labels)]
    df = spark.createDataFrame(rows, "id string, y int")
    got = {r["id"]: r["split"] for r in prep.stratified_split(df, "y", "id", frac, 7).collect()}
    assert set(got) == {k for k, _ in rows}
    n, share = len(labels), Fraction(str(frac))
    n_train = n - math.ceil(n * share)
    assert sum(v == "test" for v in got.values()) == n - n_train
    part = {c: divmod(n_train * labels.count(c), n) for c in set(labels)}
    spare = n_train - sum(w for w, _ in part.values())
    more = sorted(part, key=lambda c: (-part[c][1], c))[:spare]
    for c in set(labels):
        keys = sorted((hashlib.md5(f"7:{k}".encode()).hexdigest(), k) for k, y in rows if y == c)
        k_test = len(keys) - part[c][0] - (c in more)
        assert [got[k] for _, k in keys] == ["test"] * k_test + ["train"] * (len(keys) - k_test)


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from(["a", "b", ""]))),
                     min_size=0, max_size=40))
def test_duplicates_and_nulls_match_pandas(spark, rows):
    import pandas as pd

    from riskloom.operators import quality
    df = spark.createDataFrame(rows, "a int, b string")
    pdf = pd.DataFrame(rows, columns=["a", "b"])
    r = quality.validation_gate(df, min_rows=1, max_null_fraction=1.0).first()
    assert r["row_count"] == len(pdf)
    assert r["duplicate_rows"] == int(pdf.duplicated().sum())
    if len(pdf):
        assert r["null_percentage"] == pytest.approx(round(pdf.isnull().sum().sum() / (len(pdf) * 2), 6), abs=1e-9)
    else:
        assert r["null_percentage"] is None
    p = quality.row_profile(df).first()
    assert p["unique_rows"] == len(pdf.drop_duplicates())


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 30)), min_size=1, max_size=50))
def test_number_of_ranges_never_changes_percentiles(spark, rows):
    from riskloom.operators import monitoring
    df = spark.createDataFrame(rows, "g string, v int")
    tables = [sorted(map(tuple, monitoring.exact_percentiles(df, "v", by=["g"], n_buckets=n).collect()), key=str)
              for n in (1, 2, 4, None)]
    assert all(t == tables[0] for t in tables) and len(tables[0]) == len({g for g, _ in rows})

"""Every registered query with an SQL equivalent agrees with DuckDB (sf0.001)."""

import pytest

from riskloom.plans.registry import ORACLES, QUERIES

import __spark_entry__ as E
from compare import same_result
from conftest import SF_SMALL

# The training-data queries have tests of their own in tests/llm.
ORACLE = {k: v for k, v in ORACLES.items() if k in QUERIES}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, duck_small, name):
    same_result(E.queries()[name](spark, SF_SMALL), duck_small, ORACLE[name])


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["booking_id", "fraud_probability", "fraud_prediction", "risk_category",
                          "prediction_timestamp"]
    assert df.count() > 0


ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


def test_rows_only_queries_are_few():
    assert set(ROWS_ONLY) == {"evaluation_report", "table_metadata", "performance_log_row",
                              "ensemble_scores", "ensemble_evaluation", "ensemble_importance"}


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    n = df.count()
    if name == "ensemble_scores":
        test_rows = E.queries()["stratified_split"](spark, SF_SMALL).where("split = 'test'").count()
        assert n == test_rows and df.columns[0] == "booking_id"
    elif name == "ensemble_importance":
        assert n == 5 and "avg_importance" in df.columns
    else:
        assert n == 1

"""Feature importance: normalisation, three-way join, ranking, selection
(J1, A24, A25, O3, P8, O4).

Importance tables have one row per feature column, so their size is fixed
by the schema, not by the data: a window without partitioning over such a
table (used for the per-model total) touches a few hundred rows at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Fixed value that must equal the reference's: added to each model's
# importance total before dividing.
NORM_EPSILON = 1e-9
TOP_K = 10


def normalise(imp: DataFrame, value_col: str, out: str) -> DataFrame:
    """Value / (sum of values over all features + 1e-9)."""
    total = F.sum(value_col).over(Window.partitionBy())
    return imp.select("feature", (F.col(value_col) / (total + F.lit(NORM_EPSILON))).alias(out))


def rank_importances(tables: dict[str, DataFrame], digits: int | None = 6) -> DataFrame:
    """J1 + A24 + A25 + O3.

    ``tables`` maps a model name to a (feature, value) DataFrame.  Each is
    normalised, the tables are inner-joined on ``feature`` and the mean
    across models is ``avg_importance``; rows are ordered by it descending
    (feature name breaks ties).
    """
    names = list(tables)
    normed = [normalise(tables[n], "value", n) for n in names]
    joined = reduce(lambda a, b: a.join(b, "feature", "inner"), normed)
    avg = reduce(lambda a, b: a + b, [F.col(n) for n in names]) / F.lit(float(len(names)))
    out = joined.withColumn("avg_importance", avg)
    if digits is not None:
        out = out.select("feature", *[F.round(n, digits).alias(n) for n in names],
                         F.round("avg_importance", digits).alias("avg_importance"))
    return out.orderBy(F.desc("avg_importance"), F.asc("feature"))


def rounded(ranked: DataFrame, digits: int = 6) -> DataFrame:
    """The ranking with every figure rounded, for reports (select first)."""
    return ranked.select("feature", *[F.round(c, digits).alias(c) for c in ranked.columns if c != "feature"])


def select_important(ranked: DataFrame, threshold: float) -> DataFrame:
    """Features whose mean importance is strictly above ``threshold``."""
    return ranked.where(F.col("avg_importance") > F.lit(threshold))


def top_features(ranked: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k most important features (a top-k: the limit is the feature)."""
    return ranked.orderBy(F.desc("avg_importance"), F.asc("feature")).limit(k)


def data_importances(df: DataFrame, features: list[str], label_col: str) -> dict[str, DataFrame]:
    """Three deterministic, data-derived importance measures per feature:
    |Pearson correlation with the label|, |standardised mean difference
    between classes| and |relative lift of the positive-class mean|.

    One aggregation pass builds a single wide row, checkpointed to the
    shared checkpoint folder (one row); each measure is a ``stack`` of it,
    so the input is read once however many measures use it.
    """
    y = F.col(label_col)
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        pos_mean = F.avg(F.when(y == 1, x))
        neg_mean = F.avg(F.when(y == 0, x))
        aggs += [F.abs(F.corr(x, y.cast("double"))).alias(f"{f}__lr"),
                 F.abs(F.try_divide(pos_mean - neg_mean, F.stddev_pop(x))).alias(f"{f}__xgb"),
                 F.abs(F.try_divide(pos_mean, F.avg(x)) - F.lit(1.0)).alias(f"{f}__lgb")]
    ensure_checkpoint_dir(df.sparkSession)
    wide = df.agg(*aggs).checkpoint(eager=True)
    out = {}
    for m in ("lr", "xgb", "lgb"):
        pairs = ", ".join(f"'{f}', `{f}__{m}`" for f in features)
        out[m] = wide.select(F.expr(f"stack({len(features)}, {pairs}) AS (feature, value)"))
    return out


def model_importances(spark, features: list[str], values) -> DataFrame:
    """(feature, value) table from a model's importance vector (one entry
    per feature column: bounded by the schema)."""
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)], "feature string, value double")

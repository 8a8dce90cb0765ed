"""Monitoring of scored data (M1-M4, M7) and exact percentiles.

Each monitor is a grouped aggregation over the whole scored table;
per-period and per-group results are small, the inputs are not, so every
aggregation is partial (map-side) before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import known, null_ratio
from .ranking import running_totals

DEFAULT_PERCENTILES = (0.5, 0.95, 0.99)


def accuracy_trend(pred: DataFrame, labels: DataFrame, key: str, ts_col: str, label_col: str,
                   pred_col: str = "fraud_prediction", unit: str = "month") -> DataFrame:
    """M1: accuracy per period of predictions whose true label arrived later.

    Scored rows and labels are joined on the key (a shuffle join on both
    sides' key; AQE splits a skewed key partition).  Predictions without a
    label yet are left out of the accuracy and counted as ``unlabelled``.
    """
    j = pred.join(labels.select(key, label_col), key, "left")
    period = F.date_trunc(unit, F.col(ts_col)).alias("period")
    y, p = F.col(label_col), F.col(pred_col)
    return (j.groupBy(period)
             .agg(F.count(F.lit(1)).alias("n_predictions"),
                  F.count_if(y.isNotNull()).alias("n_labelled"),
                  F.count_if(y.isNull()).alias("unlabelled"),
                  F.round(null_ratio(F.count_if(y == p), F.count_if(y.isNotNull())), 6).alias("accuracy")))


def prediction_volume(pred: DataFrame, ts_col: str, unit: str = "day") -> DataFrame:
    """M2: predictions per period."""
    period = (F.to_date(ts_col) if unit == "day" else F.date_trunc(unit, F.col(ts_col))).alias("period")
    return pred.groupBy(period).agg(F.count(F.lit(1)).alias("n_predictions"))


def error_rate(events: DataFrame, type_col: str = "event_type", error_value: str = "error",
               by=None) -> DataFrame:
    """M4: share of rows whose type is ``error_value`` (per group if ``by``)."""
    rate = F.round(F.avg(F.when(F.col(type_col) == error_value, 1.0).otherwise(0.0)), 6).alias("error_rate")
    n = F.count(F.lit(1)).alias("n_events")
    errors = F.count_if(F.col(type_col) == error_value).alias("n_errors")
    if by is None:
        return events.agg(n, errors, rate)
    return events.groupBy(by).agg(n, errors, rate)


def exact_percentiles(df: DataFrame, value_col: str, probs=DEFAULT_PERCENTILES, by=(),
                      digits: int = 6, n_buckets: int | None = None) -> DataFrame:
    """M3: exact linear-interpolation percentiles (``percentile`` /
    ``quantile_cont`` semantics) per group.

    Spark's exact ``percentile`` keeps a value->count map of a whole group
    in one task; here values are first counted per (group, value) with a
    partial aggregation, ranked with distributed running totals, and only
    the rows holding the wanted ranks are kept.  Missing values (NULL, NaN)
    take no part.
    """
    by = list(by)
    c = (df.where(known(value_col).isNotNull())
           .groupBy(*by, F.col(value_col).alias("_v"))
           .agg(F.count(F.lit(1)).alias("_n")))
    r = running_totals(c, "_v", ["_n"], by=by, n_buckets=n_buckets)
    first = F.col("cum__n") - F.col("_n")       # 0-based rank of the first copy
    last = F.col("cum__n") - F.lit(1)           # 0-based rank of the last copy
    total = F.col("total__n")
    conds, aggs = [], []
    for p in probs:
        h = (total - F.lit(1)) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        tag = percentile_tag(p)
        r = r.withColumn(f"_h{tag}", h).withColumn(f"_lo{tag}", (first <= lo) & (lo <= last)) \
             .withColumn(f"_hi{tag}", (first <= hi) & (hi <= last))
        conds += [F.col(f"_lo{tag}"), F.col(f"_hi{tag}")]
    keep = conds[0]
    for c_ in conds[1:]:
        keep = keep | c_
    picked = r.where(keep)
    for p in probs:
        tag = percentile_tag(p)
        v_lo = F.max(F.when(F.col(f"_lo{tag}"), F.col("_v")))
        v_hi = F.max(F.when(F.col(f"_hi{tag}"), F.col("_v")))
        h = F.max(f"_h{tag}")
        aggs.append(F.round(v_lo + (h - F.floor(h)) * (v_hi - v_lo), digits).alias(f"p{tag}"))
    aggs.append(F.max("total__n").alias("n"))
    if by:
        return picked.groupBy(*by).agg(*aggs)
    return picked.agg(*aggs)


def percentile_tag(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return s


def psi(df: DataFrame, score_col: str, period_col: str, baseline, current, bins: int = 10,
        lo: float = 0.0, hi: float = 1.0, epsilon: float = 1e-6, digits: int | None = 6) -> DataFrame:
    """M7: population stability index of a score between two periods.

    Scores are cut into ``bins`` equal-width bins over [lo, hi] (values
    outside are clamped to the end bins).  Per bin: baseline and current
    shares (epsilon in place of an empty share) and the contribution
    (current - baseline) * ln(current / baseline).  One grouped
    aggregation; shares use per-period totals computed in the same pass.
    Missing scores (NULL, NaN) take no part.
    """
    width = (hi - lo) / bins
    b = F.least(F.greatest(F.floor((F.col(score_col) - F.lit(lo)) / F.lit(width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    per = F.col(period_col)
    counts = (df.where(per.isin(baseline, current) & known(score_col).isNotNull())
                .groupBy(b.alias("bin"))
                .agg(F.count_if(per == baseline).alias("n_baseline"),
                     F.count_if(per == current).alias("n_current")))
    # Totals per period are the sums of a table with at most ``bins`` rows.
    w = Window.partitionBy()
    e = F.greatest(null_ratio(F.col("n_baseline"), F.sum("n_baseline").over(w)), F.lit(epsilon))
    a = F.greatest(null_ratio(F.col("n_current"), F.sum("n_current").over(w)), F.lit(epsilon))
    out = counts.select("bin", "n_baseline", "n_current", e.alias("_e"), a.alias("_a"))
    rounded = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return out.select("bin", "n_baseline", "n_current",
                      rounded(F.col("_e")).alias("baseline_share"),
                      rounded(F.col("_a")).alias("current_share"),
                      rounded((F.col("_a") - F.col("_e")) * F.log(F.col("_a") / F.col("_e"))).alias("psi_contribution"))


def psi_total(bins_df: DataFrame, digits: int = 6) -> DataFrame:
    """M7 total: sum of the per-bin contributions (pass them unrounded)."""
    return bins_df.agg(F.round(F.sum("psi_contribution"), digits).alias("psi"),
                       F.count(F.lit(1)).alias("n_bins"))


def feature_drift(df: DataFrame, features: list[str], period_col: str, baseline, current, bins: int = 10,
                  epsilon: float = 1e-6, digits: int = 6) -> DataFrame:
    """M7 for every feature: ``feature, psi, n_baseline, n_current``.

    Bins are equal-width over the baseline's own range of each feature
    (values of the current period outside it fall in the end bins).  Two
    passes whatever the number of features: one aggregation for the ranges,
    one over (feature, value) records with counts combined map-side.  Missing
    values (NULL, NaN) take no part; a feature without baseline values has a
    NULL psi.
    """
    per = F.col(period_col)
    both = df.where(per.isin(baseline, current)).select(
        (per == baseline).alias("_base"), F.inline(F.array(*[
            F.struct(F.lit(f).alias("feature"), known(F.col(f"`{f}`")).alias("_x"))
            for f in features])))
    both = both.where(F.col("_x").isNotNull())
    edges = both.where("_base").groupBy("feature").agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    b = F.when(width > 0, F.least(F.greatest(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(0)), F.lit(bins - 1)))
    # One row per feature: the schema bounds the ranges' table.
    cells = (both.join(F.broadcast(edges), "feature", "left").groupBy("feature", F.coalesce(b, F.lit(0)).alias("_bin"))
             .agg(F.count_if("_base").alias("_nb"), F.count_if(~F.col("_base")).alias("_nc")))
    w = Window.partitionBy("feature")
    e = F.greatest(null_ratio(F.col("_nb"), F.sum("_nb").over(w)), F.lit(epsilon))
    a = F.greatest(null_ratio(F.col("_nc"), F.sum("_nc").over(w)), F.lit(epsilon))
    shares = cells.select("feature", "_nb", "_nc", e.alias("_e"), a.alias("_a"))
    total = F.sum((F.col("_a") - F.col("_e")) * F.log(F.col("_a") / F.col("_e")))
    return shares.groupBy("feature").agg(
        F.round(F.when(F.sum("_nb") > 0, total), digits).alias("psi"),
        F.sum("_nb").alias("n_baseline"), F.sum("_nc").alias("n_current"))

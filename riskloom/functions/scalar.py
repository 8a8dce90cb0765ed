"""Scalar column functions (F1-F12), all built from JVM-side expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's.
# Risk tiers: probability < 0.3 is LOW, < 0.7 is MEDIUM, otherwise HIGH.
RISK_LOW_BELOW = 0.3
RISK_MEDIUM_BELOW = 0.7
RISK_LABELS = ("LOW", "MEDIUM", "HIGH")
# Freshness: 0 days Current; <= 1 Recent; <= 7 Stale; otherwise Very Stale.
FRESHNESS_RECENT_DAYS = 1
FRESHNESS_STALE_DAYS = 7
# Quality assessment: score >= 80 Good, >= 60 Fair, otherwise Poor.
QUALITY_GOOD = 80
QUALITY_FAIR = 60


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def known(x) -> Column:
    """A number as a double, with NaN as NULL: NaN is a missing value here, and
    would otherwise sort above every number."""
    return F.nanvl(col_(x).cast("double"), F.lit(None).cast("double"))


def risk_tier(prob) -> Column:
    """LOW / MEDIUM / HIGH by probability.  NULL and NaN have no tier."""
    p = known(prob)
    return (F.when(p < RISK_LOW_BELOW, F.lit(RISK_LABELS[0]))
            .when(p < RISK_MEDIUM_BELOW, F.lit(RISK_LABELS[1]))
            .when(p.isNotNull(), F.lit(RISK_LABELS[2])))


def freshness_status(days) -> Column:
    """A13 with the NULL case made explicit ('No Data')."""
    d = col_(days)
    return (F.when(d.isNull(), F.lit("No Data"))
            .when(d == 0, F.lit("Current"))
            .when(d <= FRESHNESS_RECENT_DAYS, F.lit("Recent"))
            .when(d <= FRESHNESS_STALE_DAYS, F.lit("Stale"))
            .otherwise(F.lit("Very Stale")))


def quality_assessment(score) -> Column:
    s = col_(score)
    return (F.when(s >= QUALITY_GOOD, F.lit("Good"))
            .when(s >= QUALITY_FAIR, F.lit("Fair"))
            .otherwise(F.lit("Poor")))


def safe_ratio(num, den) -> Column:
    """num / den, 0 when den is 0 or NULL (ANSI-safe)."""
    return F.coalesce(F.try_divide(col_(num).cast("double"), col_(den)), F.lit(0.0))


def null_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 (no division-by-zero error in ANSI mode)."""
    return F.try_divide(col_(num).cast("double"), col_(den))


def clamp_min(x, lo: float = 0.0) -> Column:
    """F8: max(lo, x)."""
    return F.greatest(F.lit(lo), col_(x))


def bytes_to_mb(b) -> Column:
    """bytes -> MB rounded to 2 decimals."""
    return F.round(col_(b) / 1024.0 / 1024.0, 2)


def iso_timestamp(ts) -> Column:
    """ISO-8601 text of a timestamp, microseconds shown only when
    non-zero (the usual ``isoformat`` rendering)."""
    t = col_(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(t, "SSSSSS") == "000000", whole) \
            .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def run_id(ts) -> Column:
    """run-id text ``YYYYmmdd_HHMMSS``."""
    return F.date_format(col_(ts), "yyyyMMdd_HHmmss")


def as_date(value) -> Column:
    """A date literal from a ``date`` / ``datetime`` / ISO string."""
    if isinstance(value, Column):
        return F.to_date(value)
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.to_date(F.lit(value))


def ts_bound(df: DataFrame, ts_col: str, day) -> Column:
    """Midnight of ``day`` typed like ``df[ts_col]`` (timestamp or timestamp_ntz).

    Comparing the raw column against a literal of its own type keeps the
    predicate pushable into the Parquet scan; ``to_date(col) >= d`` is not.
    """
    dtype = df.schema[ts_col].dataType
    lit = as_date(day)
    if isinstance(dtype, T.DateType):
        return lit
    return lit.cast(dtype)


def date_range_predicate(df: DataFrame, ts_col: str, start=None, end=None) -> Column:
    """P5: ``start <= DATE(ts) <= end`` (both inclusive), written half-open
    on the raw column: ``ts >= start AND ts < end + 1 day``."""
    cond = F.lit(True)
    c = F.col(ts_col)
    if start is not None:
        cond = cond & (c >= ts_bound(df, ts_col, start))
    if end is not None:
        cond = cond & (c < ts_bound(df, ts_col, F.date_add(as_date(end), 1)))
    return cond

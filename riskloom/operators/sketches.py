"""Mergeable sketches of bounded size.

Exact percentiles and duplicate counts shuffle every distinct value or row.  A
sketch per period or partition is a few kilobytes, is stored beside the data,
and merges into the answer for any range of periods without reading rows again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import known
from .monitoring import DEFAULT_PERCENTILES, percentile_tag
from .quality import row_digest

#: Accuracy parameter of a quantile sketch, and log2 of the hashes that a distinct-count sketch keeps.
DEFAULT_K, DEFAULT_LG_K = 1000, 14


def rank_error_bound(k: int = DEFAULT_K) -> float:
    """Normalised rank error of a KLL sketch that holds with 99 % confidence
    (the constants that its authors publish); also after any merges."""
    return 2.296 / k**0.9021


def distinct_error_bound(lg_k: int = DEFAULT_LG_K, deviations: float = 3.0) -> float:
    """Relative error of a theta sketch's count, at so many standard deviations."""
    return deviations / math.sqrt(2**lg_k)


def quantile_sketches(df: DataFrame, value_col: str, period, by=(), k: int = DEFAULT_K) -> DataFrame:
    """One KLL sketch per (group, period): ``*by, period, sketch``.  Missing
    values (NULL, NaN) take no part; tasks sketch what they read, and only
    sketches are shuffled."""
    x = known(value_col)
    rows = df.select(*by, period.alias("period"), x.alias("_x")).where(F.col("_x").isNotNull())
    return rows.groupBy(*by, "period").agg(F.kll_sketch_agg_double("_x", k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by=(), probs=DEFAULT_PERCENTILES, k: int = DEFAULT_K) -> DataFrame:
    """Percentiles of all periods in ``sketches`` together: ``*by, p.., n``."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    return merged.select(*by, *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"p{percentile_tag(p)}")
                                for p in probs], F.kll_sketch_get_n_double("sketch").alias("n"))


def measured_rank_errors(df: DataFrame, value_col: str, estimates: DataFrame, by: list[str],
                         probs=DEFAULT_PERCENTILES) -> DataFrame:
    """How far the rank of each estimate is from its percentile, over all
    rows: ``*by, n, e..``.  An estimate that equal values share is right if
    any of their ranks is."""
    x = known(value_col)
    named = estimates.select(*[F.col(c).alias(f"_{c}") for c in by],
                             *[F.col(f"p{percentile_tag(p)}").alias(f"_e{percentile_tag(p)}") for p in probs])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    rows = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull()).join(named, same)
    n = F.count(F.lit(1))
    errors = []
    for p in probs:
        e = F.col(f"_e{percentile_tag(p)}")
        below, upto = F.count_if(F.col("_x") < e) / n, F.count_if(F.col("_x") <= e) / n
        errors.append(F.greatest(F.lit(0.0), F.lit(float(p)) - upto, below - F.lit(float(p))).alias(f"e{percentile_tag(p)}"))
    return rows.groupBy(*by).agg(n.alias("n"), *errors)


def row_sketches(df: DataFrame, part=None, lg_k: int = DEFAULT_LG_K) -> DataFrame:
    """Per partition ``part, total_rows, sketch`` (a theta sketch of the typed
    digests of whole rows; NULLs are equal)."""
    part = F.lit(0) if part is None else part
    rows = df.select(part.alias("part"), row_digest(df).alias("_row"))
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("total_rows"), F.theta_sketch_agg("_row", lg_k).alias("sketch"))


def sketched_row_profile(sketches: DataFrame, lg_k: int = DEFAULT_LG_K) -> DataFrame:
    """A7 of all partitions together, estimated: ``total_rows, unique_rows,
    duplicate_rows``."""
    one = sketches.agg(F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
                       F.theta_union_agg("sketch", lg_k).alias("sketch"))
    unique = F.least(F.coalesce(F.theta_sketch_estimate("sketch"), F.lit(0)), F.col("total_rows"))
    return one.select("total_rows", unique.alias("unique_rows"), (F.col("total_rows") - unique).alias("duplicate_rows"))


def sketched_overlap(sketches: DataFrame) -> DataFrame:
    """Distinct rows that two partitions share, estimated, for every pair of
    neighbours in the order of ``part``: ``part, other, shared_rows``."""
    from pyspark.sql import Window
    order = Window.partitionBy(F.lit(0)).orderBy("part")  # one small row per partition
    pairs = sketches.select("part", "sketch", F.lead("part").over(order).alias("other"),
                            F.lead("sketch").over(order).alias("_next")).where("other IS NOT NULL")
    return pairs.select("part", "other", F.theta_sketch_estimate(F.theta_intersection("sketch", "_next")).alias("shared_rows"))

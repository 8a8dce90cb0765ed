"""M7 on a stream: score histograms per hopping window against a stored baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import known, null_ratio


def score_bin(score_col: str, bins: int = 10, lo: float = 0.0, hi: float = 1.0) -> Column:
    """The equal-width bin of a score; values outside go to the end bins."""
    at = F.floor((F.col(score_col) - F.lit(lo)) / F.lit((hi - lo) / bins))
    return F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)).cast("int")


def windowed_histogram(scores: DataFrame, ts_col: str, score_col: str, window: str, slide: str,
                       watermark: str = "1 day", bins: int = 10) -> DataFrame:
    """``window_start, window_end, bin, n`` of a stream of scores; the state is
    ``bins`` counts per open window.  Missing scores (NULL, NaN) take no part."""
    s = scores.where(known(score_col).isNotNull()).withColumn("_et", F.col(ts_col).cast("timestamp"))
    g = s.withWatermark("_et", watermark).groupBy(F.window("_et", window, slide).alias("w"),
                                                  score_bin(score_col, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "bin", "n")


def baseline_histogram(scores: DataFrame, score_col: str, bins: int = 10) -> DataFrame:
    """``bin, n_baseline`` of the scores that a stream is compared with."""
    return (scores.where(known(score_col).isNotNull()).groupBy(score_bin(score_col, bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n_baseline")))


def windowed_psi(histogram: DataFrame, baseline: DataFrame, epsilon: float = 1e-6, digits: int = 6) -> DataFrame:
    """``window_start, window_end, n_current, psi`` per window: the figure of
    ``psi_total`` between the baseline and that window."""
    keys = ["window_start", "window_end"]
    # A baseline has a row per bin, so its size is that of one histogram.
    cells = (histogram.select(*keys).distinct().crossJoin(F.broadcast(baseline))
             .join(histogram, [*keys, "bin"], "full").fillna(0, ["n", "n_baseline"]))
    w = Window.partitionBy(*keys)
    e = F.greatest(null_ratio(F.col("n_baseline"), F.sum("n_baseline").over(w)), F.lit(epsilon))
    a = F.greatest(null_ratio(F.col("n"), F.sum("n").over(w)), F.lit(epsilon))
    shares = cells.select(*keys, "n", e.alias("_e"), a.alias("_a"))
    return shares.groupBy(*keys).agg(F.sum("n").alias("n_current"), F.round(
        F.sum((F.col("_a") - F.col("_e")) * F.log(F.col("_a") / F.col("_e"))), digits).alias("psi"))

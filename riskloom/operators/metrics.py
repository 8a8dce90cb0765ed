"""Classification metrics (A16-A22, L9): confusion, report, business impact,
exact ROC-AUC, average precision and ROC points.

Ranking metrics are computed from the table of distinct scores with their
positive/negative counts (a partial aggregation, so a score shared by a
third of all rows is one record per map task) and distributed running
totals over it — no global single-task window, no collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import known, null_ratio, safe_ratio
from .ranking import running_totals
from .scoring import VOTE_THRESHOLD

# Fixed values that must equal the reference's (cost-benefit constants).
AVG_TRANSACTION_VALUE = 1000
INVESTIGATION_COST = 50

CONFUSION = ("true_negatives", "false_positives", "false_negatives", "true_positives")


def _rates(tn, fp, fn, tp, digits=6):
    """accuracy / precision / recall / F1 columns from four count columns."""
    n = tn + fp + fn + tp
    precision = safe_ratio(tp, tp + fp)
    recall = safe_ratio(tp, tp + fn)
    f1 = safe_ratio(precision * recall * 2.0, precision + recall)
    return [F.round(null_ratio(tp + tn, n), digits).alias("accuracy"),
            F.round(precision, digits).alias("precision"),
            F.round(recall, digits).alias("recall"),
            F.round(f1, digits).alias("f1_score")]


def confusion_metrics(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """A16 + A17: tn, fp, fn, tp and the four rates, one aggregation."""
    y, p = F.col(label_col), F.col(pred_col)
    counts = df.agg(F.count_if((y == 0) & (p == 0)).alias("true_negatives"),
                    F.count_if((y == 0) & (p == 1)).alias("false_positives"),
                    F.count_if((y == 1) & (p == 0)).alias("false_negatives"),
                    F.count_if((y == 1) & (p == 1)).alias("true_positives"))
    c = [F.col(n) for n in CONFUSION]
    return counts.select(*CONFUSION, *_rates(*c))


def business_impact(conf: DataFrame, avg_transaction_value: float = AVG_TRANSACTION_VALUE,
                    investigation_cost: float = INVESTIGATION_COST) -> DataFrame:
    """Prevented value, false-alarm cost, missed-fraud cost, net benefit."""
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    prevented = (tp * float(avg_transaction_value))
    alarm = (fp * float(investigation_cost))
    missed = (fn * float(avg_transaction_value))
    return conf.select("*", prevented.alias("fraud_prevented_value"), alarm.alias("false_alarm_cost"),
                       missed.alias("missed_fraud_cost"), (prevented - alarm - missed).alias("net_benefit"))


def class_report_array(digits: int = 6):
    """A18 as an array-of-struct expression over the confusion count
    columns: per-class precision / recall / F1 / support, accuracy, macro
    and weighted averages."""
    tn, fp, fn, tp = [F.col(n) for n in CONFUSION]
    s0, s1 = tn + fp, tp + fn
    p0, r0 = safe_ratio(tn, tn + fn), safe_ratio(tn, tn + fp)
    p1, r1 = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    f0, f1 = safe_ratio(p0 * r0 * 2.0, p0 + r0), safe_ratio(p1 * r1 * 2.0, p1 + r1)
    n = s0 + s1
    acc = null_ratio(tp + tn, n)

    def row(name, p, r, f, s):
        rnd = (lambda x: F.round(x, digits).cast("double"))
        return F.struct(F.lit(name).alias("class_label"), rnd(p).alias("precision"), rnd(r).alias("recall"),
                        rnd(f).alias("f1_score"), s.cast("long").alias("support"))

    return F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None), F.lit(None), acc, n),
        row("macro avg", (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, n),
        row("weighted avg", null_ratio(p0 * s0 + p1 * s1, n), null_ratio(r0 * s0 + r1 * s1, n),
            null_ratio(f0 * s0 + f1 * s1, n), n),
    )


def class_report(conf: DataFrame, digits: int = 6) -> DataFrame:
    """A18 as rows, exploded from the one-row confusion table (no join)."""
    return conf.select(F.inline(class_report_array(digits)))


def score_counts(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """Distinct scores with their positive (``pos``) and negative (``neg``)
    counts; rows without a score (NULL, NaN) take no part."""
    y = F.col(label_col)
    return (df.where(known(score_col).isNotNull())
              .groupBy(F.col(score_col).alias("score"))
              .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))


def cumulative_by_score(df: DataFrame, label_col: str, score_col: str, n_buckets: int | None = None,
                        with_next: bool = False) -> DataFrame:
    """Per distinct score (descending): pos, neg, cum_pos, cum_neg (rows
    with score >= this score) and total_pos, total_neg; with ``with_next``
    also next_pos, next_neg (counts at the next lower score)."""
    g = score_counts(df, label_col, score_col)
    return running_totals(g, "score", ["pos", "neg"], descending=True, n_buckets=n_buckets, with_next=with_next)


def ranking_metrics(df: DataFrame, label_col: str, score_col: str, digits: int = 6,
                    n_buckets: int | None = None) -> DataFrame:
    """A20 + A21: exact ROC-AUC (ties count half) and average precision
    (step-wise sum of precision x recall increments, not a trapezoid)."""
    return ranking_from_totals(cumulative_by_score(df, label_col, score_col, n_buckets), digits)


def ranking_from_totals(r: DataFrame, digits: int = 6) -> DataFrame:
    """A20 + A21 from the running totals per distinct score."""
    pos, neg, cpos, cneg = F.col("pos"), F.col("neg"), F.col("cum_pos"), F.col("cum_neg")
    auc_num = F.sum(neg * (cpos - pos + pos / 2.0))
    ap_num = F.sum(F.when(pos > 0, pos * (cpos / (cpos + cneg))).otherwise(F.lit(0.0)))
    tot_pos, tot_neg = F.max("total_pos"), F.max("total_neg")
    # Counts of 5e9 a class multiply beyond 64 bits: the product is a double's.
    return r.agg(F.round(null_ratio(auc_num, tot_pos.cast("double") * tot_neg), digits).alias("roc_auc"),
                 F.round(null_ratio(ap_num, tot_pos), digits).alias("pr_auc"),
                 F.coalesce(tot_pos, F.lit(0)).cast("long").alias("n_positive"),
                 F.coalesce(tot_neg, F.lit(0)).cast("long").alias("n_negative"))


def roc_curve(df: DataFrame, label_col: str, score_col: str, digits: int = 6,
              n_buckets: int | None = None, drop_intermediate: bool = True) -> DataFrame:
    """(fpr, tpr) points with the real scores as thresholds ("score >=
    threshold" is positive), plus the origin at threshold +inf.

    ``drop_intermediate`` (the default of the library the reference calls)
    leaves out a point when the next lower score adds exactly the same
    positive and negative counts, i.e. the point lies on a straight segment;
    the highest and lowest scores are always kept.
    """
    r = cumulative_by_score(df, label_col, score_col, n_buckets, with_next=drop_intermediate)
    if drop_intermediate:
        first = (F.col("cum_pos") - F.col("pos") + F.col("cum_neg") - F.col("neg")) == 0
        last = F.col("next_pos").isNull()
        same_step = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
        r = r.where(first | last | ~same_step)
    pts = r.select(F.col("score").alias("threshold"),
                   F.round(null_ratio(F.col("cum_neg"), F.col("total_neg")), digits).alias("fpr"),
                   F.round(null_ratio(F.col("cum_pos"), F.col("total_pos")), digits).alias("tpr"))
    origin = r.agg(F.lit(float("inf")).alias("threshold"),
                   F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")).where(F.count(F.lit(1)) > 0)
    return pts.unionByName(origin)


def evaluation_metrics(df: DataFrame, label_col: str, score_col: str, threshold: float = VOTE_THRESHOLD,
                       digits: int = 6, n_buckets: int | None = None,
                       avg_transaction_value: float = AVG_TRANSACTION_VALUE,
                       investigation_cost: float = INVESTIGATION_COST) -> DataFrame:
    """Every evaluation figure of a scored set in one row.

    The predicted class is ``score > threshold`` (the soft-vote rule), so
    the confusion counts come from the same distinct-score table as the
    ranking metrics: one shuffle of the scored rows in total.
    """
    r = cumulative_by_score(df, label_col, score_col, n_buckets)
    pos, neg, cpos, cneg, s = F.col("pos"), F.col("neg"), F.col("cum_pos"), F.col("cum_neg"), F.col("score")
    above = s > threshold
    agg = r.agg(
        null_ratio(F.sum(neg * (cpos - pos + pos / 2.0)), F.max("total_pos").cast("double") * F.max("total_neg")).alias("_auc"),
        null_ratio(F.sum(F.when(pos > 0, pos * (cpos / (cpos + cneg))).otherwise(F.lit(0.0))), F.max("total_pos")).alias("_ap"),
        F.coalesce(F.sum(F.when(~above, neg)), F.lit(0)).cast("long").alias("true_negatives"),
        F.coalesce(F.sum(F.when(above, neg)), F.lit(0)).cast("long").alias("false_positives"),
        F.coalesce(F.sum(F.when(~above, pos)), F.lit(0)).cast("long").alias("false_negatives"),
        F.coalesce(F.sum(F.when(above, pos)), F.lit(0)).cast("long").alias("true_positives"),
    )
    c = [F.col(n) for n in CONFUSION]
    out = agg.select(F.round("_auc", digits).alias("roc_auc"), F.round("_ap", digits).alias("pr_auc"),
                     *_rates(*c, digits=digits), *CONFUSION)
    return business_impact(out, avg_transaction_value, investigation_cost)


def evaluation_report(metrics: DataFrame, model_name: str, digits: int = 6) -> DataFrame:
    """K4 shape: one row of nested structs keyed by model name, with the
    classification report as an array of structs."""
    return metrics.select(
        F.lit(model_name).alias("model_name"),
        F.struct("roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1_score").alias("metrics"),
        F.struct(*CONFUSION).alias("confusion_matrix"),
        F.struct("fraud_prevented_value", "false_alarm_cost", "missed_fraud_cost", "net_benefit").alias("business_impact"),
        class_report_array(digits).alias("classification_report"))

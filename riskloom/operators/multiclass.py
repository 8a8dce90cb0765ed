"""Confusion cells and class reports for any number of classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import null_ratio, safe_ratio


def confusion_cells(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """``label, prediction, n`` for the pairs of classes that occur; rows
    without a label or a prediction take no part.  One combining aggregate."""
    y, p = F.col(label_col).cast("string"), F.col(pred_col).cast("string")
    return (df.where(y.isNotNull() & p.isNotNull()).groupBy(y.alias("label"), p.alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def class_margins(cells: DataFrame) -> DataFrame:
    """Per class its hits and both margins: each cell counts once in its row
    and once in its column, so no join is needed."""
    hit = F.col("label") == F.col("prediction")
    zero = F.lit(0).cast("long")
    both = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("class_label"), F.when(hit, F.col("n")).otherwise(zero).alias("hits"),
                 F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("prediction").alias("class_label"), zero.alias("hits"), zero.alias("support"),
                 F.col("n").alias("predicted")))))
    return both.groupBy("class_label").agg(*[F.sum(c).alias(c) for c in ("hits", "support", "predicted")])


def multiclass_report(df: DataFrame, label_col: str, pred_col: str, digits: int = 6) -> DataFrame:
    """``class_label, precision, recall, f1_score, support`` per class that
    occurs as label or prediction, then accuracy, macro and weighted averages.
    The cells are checkpointed, so the scored rows are read once."""
    margins = class_margins(confusion_cells(df, label_col, pred_col).checkpoint())
    precision, recall = safe_ratio("hits", "predicted"), safe_ratio("hits", "support")
    rows = margins.select("class_label", "hits", "support", precision.alias("p"), recall.alias("r"),
                          safe_ratio(precision * recall * 2.0, precision + recall).alias("f"))
    rounded = (lambda c: F.round(c, digits).cast("double"))
    n = F.sum("support")
    weighted = (lambda c: null_ratio(F.sum(F.col(c) * F.col("support")), n))
    none = F.lit(None).cast("double")

    def summary(name, p, r, f):
        return F.struct(F.lit(name).alias("class_label"), rounded(p).alias("precision"), rounded(r).alias("recall"),
                        rounded(f).alias("f1_score"), n.alias("support"))

    totals = rows.agg(F.array(summary("accuracy", none, none, null_ratio(F.sum("hits"), n)),
                              summary("macro avg", F.avg("p"), F.avg("r"), F.avg("f")),
                              summary("weighted avg", weighted("p"), weighted("r"), weighted("f"))).alias("rows"))
    classes = rows.select("class_label", rounded(F.col("p")).alias("precision"), rounded(F.col("r")).alias("recall"),
                          rounded(F.col("f")).alias("f1_score"), "support")
    return classes.unionByName(totals.select(F.inline("rows")))

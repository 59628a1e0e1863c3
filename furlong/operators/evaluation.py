"""Hold-out metrics from label and score columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.functions.numeric import ratio, ratio_or_zero
from furlong.operators.ordering import running_sums


def _confusion(label: str, score: str, threshold: float) -> list:
    hit, positive = F.col(score) >= threshold, F.col(label) == 1
    cells = {"tp": hit & positive, "fp": hit & ~positive, "tn": ~hit & ~positive, "fn": ~hit & positive}
    return [F.count_if(c).alias(n) for n, c in cells.items()]


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """One row: accuracy, precision, recall and F1 at a threshold; a ratio without cases is 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return df.agg(*_confusion(label, score, threshold)).select(
        ratio_or_zero(tp + tn, tp + fp + tn + fn).alias("accuracy"), ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"), ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"))


def area_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """One row: tp, fp, tn, fn and the exact areas under the ROC and the precision-recall curve.

    Rows are counted per score first. Both areas are sums over the scores in falling order, from
    running sums that no single task has to compute.
    """
    counts = df.groupBy(F.col(score).alias("__score")).agg(
        F.count_if(F.col(label) == 1).alias("__p"), F.count_if(F.col(label) == 0).alias("__n"))
    cum = running_sums(counts, [F.desc("__score")], {"__tp": "__p", "__fp": "__n"})
    totals = counts.agg(F.sum("__p").alias("__P"), F.sum("__n").alias("__N"))
    tp, fp, p, n = (F.col(c) for c in ("__tp", "__fp", "__p", "__n"))
    precision = ratio(tp, tp + fp)
    earlier = F.coalesce(ratio(tp - p, tp - p + fp - n), precision)
    sums = cum.agg(F.sum(n * (tp - p + p / 2)).alias("__roc"), F.sum(p * (precision + earlier) / 2).alias("__pr"))
    cells = df.agg(*_confusion(label, score, threshold))
    # One-row tables are read as scalar subqueries, so nothing is joined.
    def at(df: DataFrame, name: str):
        return df.select(name).scalar()

    roc = ratio(at(sums, "__roc"), at(totals, "__P").cast("double") * at(totals, "__N"))
    return cells.select("tp", "fp", "tn", "fn", roc.alias("roc_auc"), ratio(at(sums, "__pr"), at(totals, "__P")).alias("pr_auc"))

"""Binary classification metrics as distributed aggregates.

Score tables have ``target`` (0/1) and ``probability``; a predicted class, where one
is needed, is ``probability >= threshold``.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.prefix import running_totals


def predicted_class(threshold: float = 0.5) -> Column:
    """1 from the threshold upwards, the threshold included."""
    return (F.col("probability") >= threshold).cast("int")


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator == 0, 0.0).otherwise(numerator / denominator)


def threshold_metrics(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: confusion counts, precision, recall, F1 (0 when undefined), accuracy,
    log loss with probabilities clipped away from 0 and 1, and the positive rate."""
    hit = predicted_class(threshold) == 1
    positive = F.col("target") == 1
    eps = sys.float_info.epsilon
    p = F.least(F.greatest(F.col("probability"), F.lit(eps)), F.lit(1.0 - eps))
    likelihood = F.when(positive, F.ln(p)).otherwise(F.ln(F.lit(1.0) - p))
    counts = scores.agg(
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
        F.count_if(~hit & ~positive).alias("tn"),
        (-F.avg(likelihood)).alias("loss"),
        F.avg("target").alias("positive_rate"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ((tp + tn) / F.nullif(tp + fp + fn + tn, F.lit(0))).alias("accuracy"),
        "loss",
        "positive_rate",
    )


def ranking_metrics(scores: DataFrame) -> DataFrame:
    """One row: average precision (step sum) and ROC-AUC, equal scores as one step.

    Scores collapse to one row each before they are ordered, so ties cost nothing,
    and the cumulative counts come from the distributed running totals.
    """
    steps = scores.groupBy("probability").agg(
        F.count_if(F.col("target") == 1).alias("pos"),
        F.count_if(F.col("target") == 0).alias("neg"),
    )
    ranked = running_totals(steps, [F.desc("probability")], ["pos", "neg"])
    above = F.col("pos_before") + F.col("pos")
    precision = above / (above + F.col("neg_before") + F.col("neg"))
    totals = ranked.agg(
        F.sum(F.col("pos") * precision).alias("ap_sum"),
        F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2)).alias("auc_sum"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )
    positives, negatives = F.col("positives"), F.col("negatives")
    pairs = positives.cast("double") * negatives
    return totals.select(
        _ratio(F.col("ap_sum"), positives).alias("avg_precision"),
        F.when(pairs > 0, F.col("auc_sum") / pairs).alias("roc_auc"),
    )


def _as_rows(row: DataFrame, names: list[str], prefix: str) -> DataFrame:
    pairs = [
        F.struct(F.lit(prefix + n).alias("metric"), F.col(n).cast("double").alias("value"))
        for n in names
    ]
    return row.select(F.inline(F.array(*pairs)))


def metric_report(
    scores: DataFrame, threshold: float = 0.5, prefix: str = "validation_"
) -> DataFrame:
    """Rows (metric, value) for all metrics and the positive rate."""
    at_threshold = ["loss", "accuracy", "f1", "recall", "precision", "positive_rate"]
    return _as_rows(threshold_metrics(scores, threshold), at_threshold, prefix).unionByName(
        _as_rows(ranking_metrics(scores), ["avg_precision", "roc_auc"], prefix)
    )

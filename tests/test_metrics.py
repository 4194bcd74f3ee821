import math
import random

import pytest

from parcelflow.plans.metrics import metric_report, ranking_metrics, threshold_metrics


def scores(spark, pairs):
    return spark.createDataFrame(pairs, "target int, probability double")


def brute_force(pairs):
    positives = [p for y, p in pairs if y == 1]
    negatives = [p for y, p in pairs if y == 0]
    auc = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in positives for n in negatives)
    auc /= len(positives) * len(negatives)
    ap, previous = 0.0, 0.0
    for t in sorted({p for _, p in pairs}, reverse=True):
        hits = [y for y, p in pairs if p >= t]
        recall = sum(hits) / len(positives)
        ap += (recall - previous) * sum(hits) / len(hits)
        previous = recall
    return ap, auc


@pytest.mark.parametrize("distinct", [3, 50, 10_000])
def test_ranking_metrics(spark, many_slices, distinct):
    rng = random.Random(distinct)
    pairs = [(int(rng.random() < 0.3), rng.randrange(distinct) / distinct) for _ in range(400)]
    row = ranking_metrics(scores(spark, pairs)).first()
    ap, auc = brute_force(pairs)
    assert row["avg_precision"] == pytest.approx(ap)
    assert row["roc_auc"] == pytest.approx(auc)


def test_one_tie_is_one_step(spark):
    row = ranking_metrics(scores(spark, [(1, 0.5), (0, 0.5)])).first()
    assert (row["avg_precision"], row["roc_auc"]) == (0.5, 0.5)


def test_auc_needs_both_classes(spark):
    row = ranking_metrics(scores(spark, [(0, 0.5), (0, 0.7)])).first()
    assert row["roc_auc"] is None and row["avg_precision"] == 0


def test_threshold_is_inclusive(spark):
    row = threshold_metrics(scores(spark, [(1, 0.5), (0, 0.6), (1, 0.4), (0, 0.1)])).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (1, 1, 1, 1)
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.5, 0.5, 0.5, 0.5)


def test_undefined_ratios_are_zero(spark):
    row = threshold_metrics(scores(spark, [(1, 0.1), (0, 0.1)])).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0, 0, 0)


def test_loss_clips_certain_scores(spark):
    row = threshold_metrics(scores(spark, [(1, 1.0), (0, 0.0), (1, 0.25)])).first()
    assert row["loss"] == pytest.approx(-math.log(0.25) / 3)
    wrong = threshold_metrics(scores(spark, [(1, 0.0)])).first()
    assert math.isfinite(wrong["loss"])


def test_report_names(spark):
    rows = metric_report(scores(spark, [(1, 0.9), (0, 0.2), (0, 0.6)])).collect()
    got = {r["metric"]: r["value"] for r in rows}
    assert set(got) == {
        f"validation_{m}"
        for m in (
            "loss",
            "accuracy",
            "f1",
            "recall",
            "precision",
            "avg_precision",
            "roc_auc",
            "positive_rate",
        )
    }
    assert got["validation_positive_rate"] == pytest.approx(1 / 3)

import random

import pytest

from tidemill.operators.threshold import confusion_at_threshold, select_threshold_max_f1

SCHEMA = "anomaly_score double, is_actual_anomaly boolean"


def frame(spark, scores, labels):
    return spark.createDataFrame(list(zip(map(float, scores), labels)), SCHEMA)


def brute(scores, labels):
    best = None
    for tau in sorted(set(scores)):
        tp = sum(s >= tau and a for s, a in zip(scores, labels))
        fp = sum(s >= tau and not a for s, a in zip(scores, labels))
        fn = sum(s < tau and a for s, a in zip(scores, labels))
        p = tp / (tp + fp) if tp + fp else 0.0
        r = tp / (tp + fn) if tp + fn else 0.0
        f = 2 * p * r / (p + r) if p + r else 0.0
        best = max(best, (f, p, r, -tau)) if best else (f, p, r, -tau)
    return best


def chosen(df, **options):
    (row,) = select_threshold_max_f1(df, **options).collect()
    return row


@pytest.mark.parametrize(
    "scores, labels, tau",
    [
        ([0.9, 0.85, 0.8, 0.2, 0.15, 0.1], [True] * 3 + [False] * 3, 0.8),
        ([0.9, 0.7, 0.6, 0.4, 0.3, 0.1], [True, True, False, True, False, False], 0.4),
        ([0.9, 0.85, 0.8], [True, False, True], 0.8),
        # all F1 equal (no anomaly at all): precision and recall tie too, the smallest wins
        ([0.5, 0.4, 0.3], [False, False, False], 0.3),
        # F1 ties at 2/3 for two thresholds with different precision
        ([0.9, 0.8, 0.7, 0.6], [True, False, False, True], 0.9),
    ],
)
def test_vectors(spark, scores, labels, tau):
    row = chosen(frame(spark, scores, labels))
    assert row["threshold"] == tau
    assert (row["f1"], row["precision"], row["recall"], -row["threshold"]) == brute(scores, labels)


def test_candidates_are_distinct_scores(spark):
    assert chosen(frame(spark, [0.5, 0.5, 0.9, 0.1], [True, False, True, False]))["candidates_evaluated"] == 3


def test_empty_input_selects_nothing(spark):
    assert select_threshold_max_f1(frame(spark, [], [])).collect() == []


@pytest.mark.parametrize("max_rows", [10_000, 11])
def test_equals_brute_force(spark, max_rows):
    rng = random.Random(max_rows)
    scores = [round(rng.random(), 2) for _ in range(300)]
    labels = [rng.random() < s for s in scores]
    row = chosen(frame(spark, scores, labels), max_rows=max_rows)
    assert (row["f1"], row["precision"], row["recall"], -row["threshold"]) == brute(scores, labels)


def test_boundary_is_inclusive_and_zero_denominators_are_zero(spark):
    (row,) = confusion_at_threshold(frame(spark, [0.6, 0.59], [True, True]), 0.6).collect()
    assert (row["tp"], row["fn"]) == (1, 1)
    (row,) = confusion_at_threshold(frame(spark, [0.1], [False]), 0.6).collect()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)

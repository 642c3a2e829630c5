"""Hand-derived metric values and brute-force checks."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as m

ORDER = ["id"]


def frame(spark, labels, scores, partitions=2):
    rows = [(f"{i:04d}", y, float(s)) for i, (y, s) in enumerate(zip(labels, scores, strict=True))]
    return spark.createDataFrame(rows, "id string, label int, score double").repartition(partitions)


@pytest.mark.parametrize(
    ("labels", "scores", "expected"),
    [([1, 0, 1, 0], [4, 3, 2, 1], 0.833333), ([0, 1], [1, 0], 0.5), ([1, 0, 1, 0], [1, 1, 1, 1], 0.5)],
)
def test_average_precision(spark, labels, scores, expected):
    assert m.pr_auc(frame(spark, labels, scores)).first()[0] == pytest.approx(expected, abs=1e-6)


def test_roc_area_and_brier(spark):
    assert m.roc_auc(frame(spark, [1, 0, 1, 0], [4, 3, 2, 1])).first()[0] == pytest.approx(0.75)
    assert m.roc_auc(frame(spark, [1, 0, 1, 0], [1, 1, 1, 1])).first()[0] == pytest.approx(0.5)
    assert m.brier(frame(spark, [1, 0], [0.8, 0.3])).first()[0] == pytest.approx(0.065)


def test_capacity(spark):
    labels = [1, 1, 0, 0, 1, 0, 0, 0, 0, 0]
    row = m.at_capacity(frame(spark, labels, range(10, 0, -1)), ORDER, 0.3).first()
    assert row["recall_at_capacity"] == pytest.approx(2 / 3)
    assert row["precision_at_capacity"] == pytest.approx(2 / 3)
    assert m.reviewed_count(10, 0.01) == 1
    with pytest.raises(ValueError):
        m.reviewed_count(10, 0.0)


@pytest.mark.parametrize("capacity", [0.1, 0.35, 0.5, 1.0])
def test_capacity_inside_a_tie_takes_rows_in_order(spark, capacity):
    rng = random.Random(2)
    labels = [int(rng.random() < 0.3) for _ in range(60)]
    scores = [rng.choice([0.1, 0.5, 0.9]) for _ in range(60)]
    got = m.at_capacity(frame(spark, labels, scores, 5), ORDER, capacity).first()
    ranked = sorted(range(60), key=lambda i: (-scores[i], i))[: m.reviewed_count(60, capacity)]
    assert got["caught"] == sum(labels[i] for i in ranked)


def test_threshold_is_the_true_lowest_argmin(spark):
    rng = random.Random(9)
    labels = [int(rng.random() < 0.2) for _ in range(200)]
    scores = [round(rng.random(), 2) for _ in range(200)]
    df = frame(spark, labels, scores, 7)
    costs = {}
    for t in sorted(set(scores)):
        fn = sum(y and s < t for y, s in zip(labels, scores, strict=True))
        fp = sum((not y) and s >= t for y, s in zip(labels, scores, strict=True))
        costs[t] = (5 * fn + fp) / 200
    expected = min(costs, key=lambda t: (costs[t], t))
    best = m.best_threshold(m.cost_curve(df)).first()
    assert best["threshold"] == expected and best["cost"] == pytest.approx(costs[expected])
    grid = {r["threshold"]: r["cost"] for r in m.cost_curve(df, thresholds=[0.25, 0.5, 2.0]).collect()}
    assert grid[2.0] == pytest.approx(5 * sum(labels) / 200)
    with pytest.raises(ValueError):
        m.cost_curve(df, 0)


def test_curves_do_not_depend_on_layout(spark):
    rng = random.Random(4)
    labels = [int(rng.random() < 0.3) for _ in range(300)]
    scores = [round(rng.random(), 1) for _ in range(300)]
    results = [
        sorted(tuple(r) for r in m.ranking_curve(frame(spark, labels, scores, p)).collect()) for p in (1, 3, 17)
    ]
    assert results[0] == results[1] == results[2]


def test_guards(spark):
    with pytest.raises(ValueError):
        m.require_scores(frame(spark, [0, 2], [0.1, 0.2]))
    with pytest.raises(ValueError):
        m.require_scores(frame(spark, [0, 1], [0.1, float("nan")]))
    with pytest.raises(ValueError):
        m.require_scores(frame(spark, [0, 0], [0.1, 0.2]))
    with pytest.raises(ValueError):
        m.require_scores(frame(spark, [0, 1], [0.1, 1.2]), probabilities=True)
    assert m.require_scores(frame(spark, [0, 1], [0.1, 0.2]), both_classes=True) == (2, 1)


def test_summary_reliability_confusion_and_baseline(spark):
    labels = [0] * 15 + [1] * 5
    df = frame(spark, labels, [i / 20 for i in range(20)])
    row = m.summary(df, ORDER, 0.25).first()
    assert row["pr_auc"] == pytest.approx(1.0) and row["lift_at_capacity"] == pytest.approx(4.0)
    bins = m.reliability(df, 4).collect()
    assert sorted(r["n"] for r in bins) == [5, 5, 5, 5]
    cut = m.confusion(df, 0.75).first()
    assert (cut["tp"], cut["fp"], cut["fn"], cut["tn"]) == (5, 0, 0, 15)
    assert sum(r["share"] for r in m.confusion_shares(df, 0.75).collect()) == pytest.approx(1.0)
    base = m.trivial_baseline(df).first()
    assert base["accuracy"] == pytest.approx(0.75) and base["recall"] == 0.0


def test_nearest_rank(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "ms double")
    assert m.nearest_rank(df, "ms") == 95.0
    assert m.nearest_rank(df.limit(1), "ms") == 1.0


def test_many_frames_at_once_score_as_each_alone(spark):
    rng = random.Random(5)
    frames = {g: frame(spark, [rng.randint(0, 1) for _ in range(60)] + [1], [rng.randint(0, 9) for _ in range(61)]) for g in "abc"}
    together = frames["a"].withColumn("g", F.lit("a"))
    for g in "bc":
        together = together.unionByName(frames[g].withColumn("g", F.lit(g)))
    got = {r["g"]: r["pr_auc"] for r in m.pr_auc_by(together, "g").collect()}
    assert got == {g: pytest.approx(m.pr_auc_value(df)) for g, df in frames.items()}


def test_one_frame_without_positives_stops_them_all(spark):
    bad = frame(spark, [0, 0], [1, 2]).withColumn("g", F.lit("b"))
    with pytest.raises(ValueError):
        m.pr_auc_by(frame(spark, [1, 0], [1, 2]).withColumn("g", F.lit("a")).unionByName(bad), "g")

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest

from tidemark.operators import splits
from tidemark.settings import MARKETPLACE, DateWindow, EvaluationLocked, ModelWindows

SCHEMA = "order_id string, order_purchase_timestamp timestamp_ntz, is_late boolean"


def orders(spark, n=50, start=datetime(2017, 5, 1), step=timedelta(hours=1)):
    """Several orders share every timestamp."""
    rows = [(f"{(i * 7) % n:04d}", start + step * (i // 4), i % 5 == 0) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_window_includes_its_last_second(spark):
    window = DateWindow("w", date(2017, 5, 1), date(2017, 5, 2))
    rows = [("a", datetime(2017, 5, 2, 23, 59, 59), True), ("b", datetime(2017, 5, 3), True)]
    assert [r["order_id"] for r in splits.select_window(spark.createDataFrame(rows, SCHEMA), window).collect()] == ["a"]
    with pytest.raises(KeyError):
        splits.select_window(spark.createDataFrame(rows, SCHEMA), window, "absent")


def test_windows_must_be_disjoint_and_ordered():
    w = lambda a, b: DateWindow("w", date(2017, a, 1), date(2017, b, 1))
    with pytest.raises(ValueError):
        ModelWindows("v", w(1, 4), w(3, 5), date(2017, 5, 1))
    with pytest.raises(ValueError):
        ModelWindows("v", w(4, 5), w(1, 2), date(2017, 2, 1))
    with pytest.raises(ValueError):
        w(4, 1)
    splits.check_calendar(MARKETPLACE)
    with pytest.raises(ValueError):
        splits.check_calendar(replace(MARKETPLACE, evaluation=w(3, 4)))
    with pytest.raises(KeyError):
        MARKETPLACE.version("v9")


def test_folds_never_train_on_the_future(spark):
    folded = splits.time_folds(orders(spark, 53), 4).collect()
    size = 53 // 5
    counts = {f: sum(r["fold"] == f for r in folded) for f in range(5)}
    assert counts == {0: 53 - 4 * size, 1: size, 2: size, 3: size, 4: size}
    for fold in range(1, 5):
        train = max(r["order_purchase_timestamp"] for r in folded if r["fold"] < fold)
        assert train <= min(r["order_purchase_timestamp"] for r in folded if r["fold"] == fold)
    with pytest.raises(ValueError):
        splits.fold_of(None, 3, 4)


def test_halves_and_tail(spark):
    df = orders(spark)
    for how in ("interleaved", "temporal"):
        got = splits.halves(df, how).collect()
        assert sum(r["first_half"] for r in got) == 25 and len(got) == 50
    with pytest.raises(ValueError):
        splits.halves(df, "other")
    tail = splits.with_tail(df).collect()
    assert sum(r["is_tail"] for r in tail) == 50 - int(50 * 0.85)
    with pytest.raises(ValueError):
        splits.with_tail(df, 1.0)


def test_out_of_order_counts_only_real_inversions(spark):
    ranked = splits.global_rank(orders(spark), splits.TOTAL_ORDER)
    assert splits.out_of_order(ranked).first()[0] == 0
    flipped = ranked.withColumn("rank", 49 - ranked["rank"])
    assert splits.out_of_order(flipped).first()[0] > 0


def test_empty_window_fails(spark):
    with pytest.raises(ValueError, match="no rows"):
        splits.require_temporal_order(orders(spark), MARKETPLACE, "v1")
    both = orders(spark).unionByName(orders(spark, start=datetime(2018, 1, 5)))
    assert splits.require_temporal_order(both, MARKETPLACE, "v1")["ordered"]


def test_evaluation_is_locked_outside_its_readers(spark):
    df = orders(spark, start=datetime(2018, 6, 1))
    for reader in ("anyone", "", "tune"):
        with pytest.raises(EvaluationLocked):
            splits.evaluation_rows(df, MARKETPLACE, reader)
        with pytest.raises(EvaluationLocked):
            MARKETPLACE.named_windows(reader)
    with pytest.raises(EvaluationLocked):
        splits.select_window(df, MARKETPLACE.evaluation)
    assert not hasattr(MARKETPLACE.evaluation, "stop")
    assert splits.evaluation_rows(df, MARKETPLACE, "holdout").count() == 50
    with pytest.raises(EvaluationLocked):
        splits.evaluation_rows(df, MARKETPLACE, "anyone")

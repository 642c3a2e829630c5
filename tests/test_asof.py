"""Snapshot boundaries, cold start, fallbacks, and the recount by definition."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof
from tidemark.operators.reconcile import reconciliation
from tidemark.settings import DateWindow

WINDOW = DateWindow("w", date(2017, 1, 1), date(2017, 4, 30))
RESOLVED = (
    "seller_id string, seller_state string, route string, customer_state string, dominant_category string, "
    "order_delivered_customer_date timestamp_ntz, is_late boolean, delivery_days double, handling_days double"
)


def row(when, late=False, days=10.0, handling=2.0, seller="s1", category="c1"):
    return (seller, "SP", "SP->RJ", "RJ", category, when, late, days, handling)


def snapshot(spark, rows, level="seller"):
    df = spark.createDataFrame(rows, RESOLVED)
    out = asof.expanding_snapshot(df, WINDOW, level).collect()
    return {(r[0], r["snapshot_month"].month) if level != "global" else r["snapshot_month"].month: r for r in out}


def test_outcome_on_the_first_instant_is_not_yet_known(spark):
    got = snapshot(spark, [row(datetime(2017, 2, 1)), row(datetime(2017, 1, 31, 23, 59, 59), seller="s2")])
    assert ("s1", 2) not in got and got["s1", 3]["order_count"] == 1
    assert got["s2", 2]["order_count"] == 1


def test_snapshots_expand_and_keep_quiet_months(spark):
    got = snapshot(spark, [row(datetime(2016, 6, 1), True), row(datetime(2017, 3, 5))])
    assert [got["s1", m]["order_count"] for m in (1, 2, 3, 4)] == [1, 1, 1, 2]
    assert got["s1", 4]["late_rate"] == 0.5


def test_unknown_handling_is_neither_zero_nor_counted(spark):
    got = snapshot(spark, [row(datetime(2017, 1, 5), handling=None), row(datetime(2017, 2, 5), handling=3.0)])
    assert got["s1", 2]["avg_handling_days"] is None and got["s1", 2]["order_count"] == 1
    assert got["s1", 3]["avg_handling_days"] == pytest.approx(3.0)


def test_null_key_has_no_snapshot_but_counts_globally(spark):
    rows = [row(datetime(2017, 1, 5), category=None)]
    assert snapshot(spark, rows, "category") == {}
    assert snapshot(spark, rows, "global")[2]["order_count"] == 1


@pytest.mark.parametrize("level", list(asof.LEVELS))
def test_running_sums_equal_the_recount(spark, level):
    rows = [
        row(datetime(2016 + i % 2, 1 + i % 5, 1 + i % 28, i % 24), i % 4 == 0, i * 0.37, None if i % 3 else i * 0.11, f"s{i % 7}", [None, "c1", "c2"][i % 3])
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, RESOLVED).repartition(5)
    key = asof.LEVELS[level]
    keys = ([key] if key else []) + ["snapshot_month"]
    tolerances = {"order_count": None, "late_rate": 1e-9, "avg_delivery_days": 1e-9, "avg_handling_days": 1e-9}
    counts = reconciliation(
        asof.expanding_snapshot(df, WINDOW, level), asof.recount_snapshot(df, WINDOW, level), keys, tolerances
    ).first()
    assert counts["differing"] == 0


def test_layout_does_not_move_a_bit(spark):
    rows = [row(datetime(2017, 1 + i % 3, 1 + i % 27), i % 5 == 0, 1 / (i + 1), i / 7) for i in range(200)]
    results = []
    for partitions in (1, 3, 17):
        df = spark.createDataFrame(rows, RESOLVED).repartition(partitions)
        results.append(sorted(tuple(r) for r in asof.expanding_snapshot(df, WINDOW, "seller").collect()))
    assert results[0] == results[1] == results[2]


ORDERS = "order_id string, purchase_month timestamp_ntz, seller_id string, seller_state string, route string, customer_state string, dominant_category string"


def attach(spark, history, orders):
    resolved = spark.createDataFrame(history, RESOLVED)
    ledger = asof.snapshot_ledger(resolved, WINDOW)
    df = spark.createDataFrame(orders, ORDERS)
    return {r["order_id"]: r for r in asof.attach_history(df, asof.levels_of(ledger)).collect()}


def order(ident, month, seller="s1", state="SP", route="SP->RJ", to="RJ", category="c1"):
    return (ident, datetime(2017, month, 1), seller, state, route, to, category)


def test_fallback_chain_is_per_metric(spark):
    history = [
        row(datetime(2017, 1, 5), True, 20.0, None, "s1"),
        row(datetime(2017, 1, 6), False, 10.0, 4.0, "s2"),
    ]
    got = attach(
        spark,
        history,
        [
            order("own", 2),
            order("cold", 2, seller="s9"),
            order("far", 2, "s9", "AM", "AM->AC", "AC", None),
            order("early", 1),
        ],
    )
    own = got["own"]
    assert own["seller_late_rate_hist"] == 1.0 and not own["seller_is_new"]
    assert own["seller_avg_handling_days_hist"] == pytest.approx(4.0)  # inherited from the state
    cold = got["cold"]
    assert cold["seller_is_new"] and cold["seller_order_count_hist"] == 0
    assert cold["seller_late_rate_hist"] == 0.5
    far = got["far"]
    assert far["route_is_new"] and far["category_is_new"]
    assert far["seller_avg_delivery_days_hist"] == pytest.approx(15.0)  # global
    early = got["early"]
    assert early["seller_late_rate_hist"] is None and early["seller_order_count_hist"] == 0


def test_attached_rows_do_not_fan_out(spark):
    history = [row(datetime(2017, 1, 1 + i), seller=f"s{i % 3}") for i in range(20)]
    got = attach(spark, history, [order(str(i), 1 + i % 4, f"s{i % 5}") for i in range(40)])
    assert len(got) == 40


def test_bundled_month_has_both_off_by_ones_right(spark):
    ledger = asof.snapshot_ledger(spark.createDataFrame([row(datetime(2016, 12, 5))], RESOLVED), WINDOW)
    assert asof.bundled_month(ledger, date(2017, 2, 28)) == date(2017, 3, 1)
    assert asof.bundled_month(ledger, date(2017, 2, 27)) == date(2017, 2, 1)
    with pytest.raises(ValueError):
        asof.bundled_month(ledger, date(2016, 12, 30))


def test_duplicate_snapshot_keys_are_found(spark):
    snap = asof.expanding_snapshot(spark.createDataFrame([row(datetime(2017, 1, 5))], RESOLVED), WINDOW, "seller")
    assert asof.duplicate_keys(snap).isEmpty()
    assert not asof.duplicate_keys(snap.unionByName(snap)).isEmpty()


def test_month_spine(spark):
    months = [r[0].month for r in asof.month_spine(spark, WINDOW).orderBy(F.col("snapshot_month")).collect()]
    assert months == [1, 2, 3, 4]


def test_inflight_keeps_quiet_months(spark):
    bought = [("a", datetime(2017, 1, 5)), ("b", datetime(2017, 5, 5))]
    done = [("a", datetime(2017, 2, 10), True), ("b", datetime(2017, 5, 20), False)]
    got = asof.inflight_vs_resolved(
        spark.createDataFrame(bought, "order_id string, order_purchase_timestamp timestamp_ntz"),
        spark.createDataFrame(done, "order_id string, order_delivered_customer_date timestamp_ntz, is_late boolean"),
        DateWindow("w", date(2017, 1, 1), date(2017, 6, 30)),
    ).collect()
    counts = [(r["cutoff_month"].month, r["resolved_orders"], r["inflight_orders"]) for r in sorted(got)]
    assert counts == [(2, 0, 1), (3, 1, 0), (4, 1, 0), (5, 1, 0), (6, 2, 0)]


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_stored_levels_count_for_what_they_are(spark):
    rows = [row(datetime(2017, 1 + i % 3, 5), seller=f"s{i:05d}") for i in range(3000)]
    ledger = asof.snapshot_ledger(spark.createDataFrame(rows, RESOLVED), WINDOW)
    stored = asof.stored_levels(ledger)
    for level, plain in asof.levels_of(ledger).items():
        assert stored[level].columns == plain.columns
        assert stored[level].exceptAll(plain).isEmpty() and plain.exceptAll(stored[level]).isEmpty()
    size = {level: int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for level, df in stored.items()}
    assert size["seller_state"] * 5 < size["seller"]


def test_a_level_without_rows_is_stored_too(spark):
    rows = [row(datetime(2017, 1, 5), category=None)]
    stored = asof.stored_levels(asof.snapshot_ledger(spark.createDataFrame(rows, RESOLVED), WINDOW))
    assert stored["category"].count() == 0 and stored["seller"].count() == 3


def test_recount_moves_orders_and_not_their_repeats(spark):
    df = spark.createDataFrame([row(datetime(2017, 1, 5))], RESOLVED)
    (only,) = exchanges(asof.recount_snapshot(df, WINDOW, "seller"))
    assert "snapshot_month" not in only


def test_drift_reads_both_months_without_moving_orders(spark):
    """Two attached frames of the same orders were joined on the order, which moved every order twice."""
    from tests.conftest import SF_SMALL
    from tidemark.plans.catalog import QUERIES

    drift = QUERIES["history_drift"].run(spark, SF_SMALL)
    plan = drift._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "order_id" in line]
    shares = {r["feature"]: r["share_changed"] for r in drift.collect()}
    assert len(shares) == 12 and 0 < shares["seller_order_count_hist"] <= 1

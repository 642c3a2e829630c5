"""Which orders count, how many were dropped, and what became of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timing import days_between, later_date, ntz
from tidemark.settings import PURCHASED_AT, DateWindow


def within(window: DateWindow, column: str = PURCHASED_AT) -> Column:
    """Predicate: the timestamp falls on a date of the window, last day included."""
    return (F.col(column) >= ntz(window.start)) & (F.col(column) < ntz(window.stop))


def delivered_orders(orders: DataFrame, window: DateWindow) -> DataFrame:
    """Orders marked delivered, with a delivery time, purchased inside the window."""
    return orders.where(
        (F.col("order_status") == "delivered")
        & F.col("order_delivered_customer_date").isNotNull()
        & within(window)
    )


def is_late() -> Column:
    """Compared as dates: the promise is a date, stored as midnight."""
    return later_date(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))


def order_outcomes(orders: DataFrame, window: DateWindow) -> DataFrame:
    """What happened after purchase. Only history and labels may read this table."""
    purchased, delivered = F.col(PURCHASED_AT), F.col("order_delivered_customer_date")
    handed = F.col("order_delivered_carrier_date")
    credible = (handed >= purchased) & (handed <= delivered)
    return delivered_orders(orders, window).select(
        "order_id",
        "order_delivered_customer_date",
        "order_delivered_carrier_date",
        is_late().alias("is_late"),
        days_between(delivered, purchased).alias("delivery_days"),
        # A handoff before purchase or after delivery is a recording error, not a speed.
        F.when(credible, days_between(handed, purchased)).alias("handling_days"),
    )


def funnel(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each successive predicate, with drops, from one scan.

    Returns (step, label, n, dropped, kept_share). ``kept_share`` is null after an empty step.
    """
    counts, passed = [], F.lit(True)
    for position, (_, predicate) in enumerate(steps):
        passed = passed & F.coalesce(predicate, F.lit(False))
        counts.append(F.count_if(passed).alias(f"n{position}"))
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(label).alias("label"), F.col(f"n{i}").alias("n"))
            for i, (label, _) in enumerate(steps)
        ]
    )
    table = df.agg(*counts).select(F.inline(rows))
    # As many rows as steps.
    before = F.lag("n").over(Window.orderBy("step"))
    return table.select(
        "step",
        "label",
        "n",
        F.coalesce(before - F.col("n"), F.lit(0)).alias("dropped"),
        F.when(before.isNull(), F.lit(1.0)).otherwise(F.col("n") / F.nullif(before, F.lit(0))).alias("kept_share"),
    )


def order_funnel(orders: DataFrame, window: DateWindow) -> DataFrame:
    return funnel(
        orders,
        [
            ("all raw orders", F.lit(True)),
            ("status = 'delivered'", F.col("order_status") == "delivered"),
            ("+ delivery date not null", F.col("order_delivered_customer_date").isNotNull()),
            ("+ purchased inside the analysis window", within(window)),
        ],
    )


def label_rules(orders: DataFrame, window: DateWindow) -> DataFrame:
    """Late rate by date and by timestamp, side by side."""
    by_timestamp = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return delivered_orders(orders, window).agg(
        F.count("*").alias("orders"),
        F.avg(is_late().cast("int")).alias("late_rate_by_date"),
        F.avg(by_timestamp.cast("int")).alias("late_rate_by_timestamp"),
    )

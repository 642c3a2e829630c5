"""Where every raw order went: one exit reason each, and the counts that have to follow from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.population import within
from tidemark.settings import DateWindow
from tidemark.sources.tables import RawTables

KEPT, LOST = "kept", "lost"


def order_exits(raw: RawTables, window: DateWindow, published: DataFrame) -> DataFrame:
    """order_id, passed (funnel steps, 1 to 4), exit and published of every raw order.

    The exit is the first reason that applies, else ``kept`` if the order is in ``published`` and
    ``lost`` if it is not. Items and payments are reduced to one row per order first, so the
    order-keyed joins see no repeated key and share one partitioning.
    """
    products = raw.products.select("product_id", F.lit(1).alias("known_product")).distinct()
    sellers = raw.sellers.select("seller_id", F.lit(1).alias("known_seller")).distinct()
    # Counted per order and pair first: one giant order is its distinct pairs before it is joined.
    lines = raw.items.select("order_id", "product_id", "seller_id").distinct()
    items = (
        lines.join(products, "product_id", "left")
        .join(sellers, "seller_id", "left")
        .groupBy("order_id")
        .agg(F.max(F.coalesce(F.col("known_product") * F.col("known_seller"), F.lit(0))).alias("described"))
    )
    payments = raw.payments.select("order_id", F.lit(1).alias("paid")).distinct()
    customers = raw.customers.select("customer_id", F.lit(1).alias("known_customer")).distinct()
    there = published.select("order_id", F.lit(True).alias("published")).distinct()
    delivered = F.coalesce(F.col("order_status") == "delivered", F.lit(False))
    dated = F.col("order_delivered_customer_date").isNotNull()
    inside = F.coalesce(within(window), F.lit(False))
    orders = raw.orders.select(
        "order_id",
        "customer_id",
        F.when(~delivered, 1).when(~dated, 2).when(~inside, 3).otherwise(4).alias("passed"),
    )
    joined = (
        orders.join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .join(there, "order_id", "left")
        .join(customers, "customer_id", "left")
    )
    passed = F.col("passed")
    reason = (
        F.when(passed == 1, "not delivered")
        .when(passed == 2, "no delivery date")
        .when(passed == 3, "outside the window")
        .when(F.col("described").isNull(), "no items")
        .when(F.col("described") == 0, "no known item")
        .when(F.col("paid").isNull(), "no payment")
        .when(F.col("known_customer").isNull(), "unknown customer")
        .when(F.col("published"), KEPT)
        .otherwise(LOST)
    )
    return joined.select("order_id", "passed", reason.alias("exit"), F.coalesce("published", F.lit(False)).alias("published"))


def exit_counts(exits: DataFrame) -> DataFrame:
    """exit and orders."""
    return exits.groupBy("exit").agg(F.count("*").alias("orders"))


def conservation(exits: DataFrame, funnel: DataFrame, published: dict[str, DataFrame]) -> DataFrame:
    """entry, expected, actual and agrees: what follows from the exits beside what was counted.

    Entries are the steps of ``funnel``, the rows of every table of ``published`` against the kept
    orders, orders lost without a reason, orders published in spite of one, and rows of
    ``published`` without a raw order. Every frame is reduced to a row before they meet.
    """
    steps = F.array(
        *[F.struct(F.lit(i).alias("step"), F.col(f"n{i}").alias("expected")) for i in range(4)]
    )
    counts = exits.agg(*[F.count_if(F.col("passed") > i).alias(f"n{i}") for i in range(4)]).select(F.inline(steps))
    parts = [funnel.join(counts, "step").select(F.col("label").alias("entry"), "expected", F.col("n").alias("actual"))]
    totals = exits.agg(
        F.count_if(F.col("exit") == KEPT).alias("kept"),
        F.count_if(F.col("exit") == LOST).alias("lost"),
        F.count_if(F.col("published") & (F.col("exit") != KEPT)).alias("intruding"),
    )
    nothing = F.lit(0).cast("long")
    parts += [
        totals.select(F.lit("lost without a reason").alias("entry"), nothing.alias("expected"), F.col("lost").alias("actual")),
        totals.select(F.lit("published in spite of a reason").alias("entry"), nothing.alias("expected"), F.col("intruding").alias("actual")),
    ]
    for name, df in published.items():
        rows = df.agg(F.count("*").alias("actual"))
        parts.append(rows.select(F.lit(f"rows of {name}").alias("entry"), totals.select("kept").scalar().alias("expected"), "actual"))
        strange = df.select("order_id").join(exits.select("order_id"), "order_id", "left_anti").agg(F.count("*").alias("actual"))
        parts.append(strange.select(F.lit(f"{name} without a raw order").alias("entry"), nothing.alias("expected"), "actual"))
    return reduce(DataFrame.unionByName, parts).withColumn("agrees", F.col("expected") == F.col("actual"))

"""Items and payments rolled up to one row per order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import dominant

#: Sums are published with 18 digits, which still fit a 64-bit unscaled value.
MONEY = "decimal(18,2)"


def cents(column: str) -> Column:
    """Money as whole cents: exact, and summed as a plain 64-bit integer."""
    return (F.col(column) * F.lit(100)).cast("bigint")


def money(total: Column) -> Column:
    return (total.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)

PRODUCT, SELLER, STATE, CATEGORY = range(4)


def item_volume() -> Column:
    return (
        F.col("product_length_cm").cast("double")
        * F.col("product_height_cm")
        * F.col("product_width_cm")
    )


def priced_items(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items with the product and seller facts the rollup needs."""
    return items.select(
        "order_id",
        "product_id",
        "seller_id",
        cents("price").alias("price"),
        cents("freight_value").alias("freight_value"),
        "shipping_limit_date",
    ).join(
        products.select(
            "product_id",
            F.col("product_category_name").alias("category"),
            F.col("product_weight_g").cast("double").alias("weight"),
            item_volume().alias("volume"),
        ),
        "product_id",
    ).join(sellers.select("seller_id", "seller_state"), "seller_id")


def order_rollup(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Counts, sums, maxima, distinct counts and dominant members per order, in one item scan.

    Items are summed per (order, product, seller, price) first, which needs no shuffle of its own after a
    shuffled product join, and leaves a single giant order only its distinct ones. These rows move
    once, to their order. There every one is spread over four facets (product, seller, seller
    state, category) and summed per (order, facet, member), so distinct counts become row counts;
    both groupings begin with the order and stay where they are. They begin with its hash, by which
    rows are sorted without comparing ids that share their first characters. The plain sums and
    maxima ride on the seller facet, which every one has exactly once.
    """
    lines = priced_items(items, products, sellers)
    pairs = lines.groupBy("order_id", "product_id", "seller_id", "seller_state", "category", "weight", "volume", "price").agg(
        F.count("*").alias("n"),
        F.sum("freight_value").alias("freight"),
        F.max("shipping_limit_date").alias("deadline"),
    )
    facets = F.array(
        *[
            F.struct(F.lit(facet).cast("tinyint").alias("facet"), F.col(member).alias("member"))
            for facet, member in (
                (PRODUCT, "product_id"),
                (SELLER, "seller_id"),
                (STATE, "seller_state"),
                (CATEGORY, "category"),
            )
        ]
    )
    spread = pairs.repartition("order_id").select(F.xxhash64("order_id").alias("place"), "*", F.inline(facets)).where(
        F.col("member").isNotNull() | (F.col("facet") == SELLER)
    )
    once = F.col("facet") == SELLER

    def riding(column: str) -> Column:
        return F.when(once, F.col(column))

    members = spread.groupBy("place", "order_id", "facet", "member").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("price")).alias("price"),
        F.max(riding("price")).alias("max_price"),
        F.sum(riding("freight")).alias("freight"),
        F.sum(F.when(once, F.col("n") * F.col("weight"))).alias("weight"),
        F.sum(F.when(once, F.col("n") * F.col("volume"))).alias("volume"),
        F.max(riding("weight")).alias("max_weight"),
        F.max(riding("volume")).alias("max_volume"),
        F.max(riding("deadline")).alias("deadline"),
    )

    def members_of(facet: int) -> Column:
        return F.count_if(F.col("facet") == facet).cast("int")

    def leading(facet: int) -> Column:
        pick = F.struct((-F.col("price")).alias("w"), F.col("member").alias("m"))
        return F.min(F.when(F.col("facet") == facet, pick))["m"]

    return members.groupBy("place", "order_id").agg(
        F.sum(F.when(once, F.col("n"))).cast("int").alias("n_items"),
        members_of(PRODUCT).alias("n_distinct_products"),
        members_of(SELLER).alias("n_distinct_sellers"),
        members_of(STATE).alias("n_seller_states"),
        money(F.sum(F.when(once, F.col("price")))).alias("total_price"),
        money(F.max("max_price")).cast("decimal(10,2)").alias("max_price"),
        money(F.sum("freight")).alias("total_freight"),
        F.sum("weight").alias("total_weight_g"),
        F.sum("volume").alias("total_volume_cm3"),
        F.max("max_weight").alias("max_item_weight_g"),
        F.max("max_volume").alias("max_item_volume_cm3"),
        F.max("deadline").alias("max_shipping_limit_date"),
        leading(SELLER).alias("seller_id"),
        leading(CATEGORY).alias("dominant_category"),
    ).drop("place")


def payment_rollup(payments: DataFrame) -> DataFrame:
    """Instalments, value, method count and dominant method per order, in one payment scan."""
    kinds = payments.groupBy("order_id", "payment_type").agg(
        F.sum(cents("payment_value")).alias("value"),
        F.max("payment_installments").alias("installments"),
    )
    pick = F.struct((-F.col("value")).alias("w"), F.col("payment_type").alias("m"))
    return kinds.groupBy("order_id").agg(
        F.min(pick)["m"].alias("dominant_payment_type"),
        F.max("installments").cast("int").alias("max_installments"),
        money(F.sum("value")).alias("total_payment_value"),
        F.count("payment_type").cast("int").alias("n_payment_methods"),
    )


def dominant_seller(items: DataFrame) -> DataFrame:
    return dominant(items, ["order_id"], "seller_id", F.sum(cents("price")), "seller_id")


def dominant_category(items: DataFrame, products: DataFrame) -> DataFrame:
    categories = products.select("product_id", F.col("product_category_name").alias("category"))
    return dominant(
        items.select("order_id", "product_id", "price").join(categories, "product_id"),
        ["order_id"],
        "category",
        F.sum(cents("price")),
        "dominant_category",
    )


def dominant_payment(payments: DataFrame) -> DataFrame:
    return dominant(payments, ["order_id"], "payment_type", F.sum(cents("payment_value")), "dominant_payment_type")


def mean_review(reviews: DataFrame) -> DataFrame:
    """One mean score per order; an order may carry several reviews."""
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("review_score"))
